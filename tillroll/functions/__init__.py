"""Column expressions made of Spark's built-in functions."""
