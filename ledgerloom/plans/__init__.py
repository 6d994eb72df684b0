"""Pipelines: ingest, mart chain (DataFrame and SQL), publish."""
