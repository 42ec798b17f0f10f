"""Column expressions. All are built-in Spark functions."""
