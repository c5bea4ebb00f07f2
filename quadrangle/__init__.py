"""Student analytics as lazily planned Spark DataFrame jobs."""
