"""Retrieval pipelines over Spark DataFrames."""
