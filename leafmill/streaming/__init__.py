"""Incremental mode on Structured Streaming."""
