"""Developer-ecosystem analytics as Spark DataFrame jobs."""
