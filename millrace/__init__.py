"""Millrace: e-commerce clickstream analytics on Spark DataFrames and Structured Streaming."""
