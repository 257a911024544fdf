"""Column-level building blocks; all of them are built-in Spark expressions."""
