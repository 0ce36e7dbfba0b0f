"""Incremental ingestion and synchronisation with Structured Streaming."""
