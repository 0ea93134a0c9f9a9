"""Retail transaction analytics as Spark DataFrame, SQL and Structured Streaming jobs."""
