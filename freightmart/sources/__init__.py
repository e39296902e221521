"""Reading tables and catalog data, and publishing results."""
