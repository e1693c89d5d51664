"""Topics and their landing as Parquet with Structured Streaming."""
