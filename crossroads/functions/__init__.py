"""Column expressions: no data access, no jobs."""
