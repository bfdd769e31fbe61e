"""Contract margin analytics as Spark jobs."""
