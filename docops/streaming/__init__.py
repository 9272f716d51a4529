"""Structured Streaming ingest of change logs."""
