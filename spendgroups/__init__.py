"""Customer grouping by income and spending, as Spark DataFrame jobs."""
