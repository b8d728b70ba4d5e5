"""Contract-driven publishing of delivered data files, as Spark DataFrame jobs."""
