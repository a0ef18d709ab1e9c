"""Column-level functions: names, geometry, colours, missing values."""
