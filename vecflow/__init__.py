"""vecflow: change-log processing for vector collections on DataFrames and Structured Streaming."""
