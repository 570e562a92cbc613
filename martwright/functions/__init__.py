"""Column builders, array/map helpers and SQL functions."""
