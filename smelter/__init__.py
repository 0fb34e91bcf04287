"""Bronze, silver and gold datasets on tables and streams, as Spark DataFrame jobs."""
