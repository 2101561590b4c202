"""Column expressions: pure Spark functions, Arrow helpers only where noted."""
