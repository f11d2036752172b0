"""Market-tick analytics as plain Spark jobs: DataFrames, SQL and Structured Streaming."""
