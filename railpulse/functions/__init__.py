"""Column-level building blocks. All of them are built-in Spark expressions."""
