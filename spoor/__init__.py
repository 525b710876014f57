"""Table and column lineage of captured Spark writes, as DataFrame jobs."""
