"""Coverage-change analytics on Spark."""
