"""Retail and event analytics as Spark DataFrame and Structured Streaming jobs."""
