"""Incremental ingest: items that keep arriving, as a Structured Streaming job."""
