"""Incremental file ingestion with Structured Streaming."""
