"""Player-event analytics as PySpark DataFrame jobs."""
