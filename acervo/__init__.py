"""Document-metadata analytics expressed as Spark DataFrame jobs."""
