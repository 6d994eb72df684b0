"""Incremental (Structured Streaming) ingest."""
