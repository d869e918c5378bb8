"""Structured Streaming: incremental ingest of parquet and record shards."""
