"""Incremental index sync with Structured Streaming."""
