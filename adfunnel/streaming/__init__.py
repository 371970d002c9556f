"""Structured Streaming form of the hourly ingest."""
