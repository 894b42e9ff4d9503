"""k-threshold measurement aggregation as Spark DataFrame jobs."""
