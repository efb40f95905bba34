"""shelfwise: retail sales analytics as Spark DataFrame jobs."""
