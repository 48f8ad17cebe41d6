"""Customer-support analytics expressed as Spark DataFrame jobs."""
