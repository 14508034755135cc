"""Column helpers: built-in Spark expressions only."""
