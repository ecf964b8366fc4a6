"""Marketing analytics expressed as Spark DataFrame jobs."""
