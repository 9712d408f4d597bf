"""Column expressions: built-in Spark functions only, usable in batch and streams."""
