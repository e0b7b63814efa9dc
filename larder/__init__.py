"""larder: recommendation and sustainability analytics as Spark DataFrame jobs."""
