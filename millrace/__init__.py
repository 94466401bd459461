"""Table and stream analytics on PySpark DataFrames, SQL, MLlib and Structured Streaming."""
