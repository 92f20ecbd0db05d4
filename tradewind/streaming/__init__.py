"""Structured Streaming versions of ingest dedup and the daily aggregate."""
