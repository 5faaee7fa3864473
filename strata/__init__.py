"""Bronze, silver and gold sales tables as Spark jobs."""
