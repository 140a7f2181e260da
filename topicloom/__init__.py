"""Document topic analytics as Spark jobs."""
