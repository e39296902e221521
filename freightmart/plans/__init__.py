"""Report pipelines. Each function takes DataFrames with the documented columns and returns one."""
