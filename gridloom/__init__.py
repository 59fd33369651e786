"""gridloom: meter-message analytics on Spark DataFrames and Structured Streaming."""
