"""Building-safety sensor analytics on Spark DataFrames and Structured Streaming."""
