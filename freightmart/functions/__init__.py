"""Column-level rules shared by every report."""
