"""Social-media analytics as Spark DataFrame jobs."""
