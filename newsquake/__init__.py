"""News-reaction analytics as Spark DataFrame jobs."""
