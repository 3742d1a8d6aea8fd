"""Regulatory performance analytics on Spark DataFrames and Structured Streaming."""
