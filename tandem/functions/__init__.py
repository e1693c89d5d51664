"""Column expressions: built-in Spark functions only, no Python in the row path."""
