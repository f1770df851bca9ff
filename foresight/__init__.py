"""Foresight: equipment-failure analytics on Spark DataFrames, Spark ML and Structured Streaming."""
