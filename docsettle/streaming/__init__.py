"""Incremental request intake on Structured Streaming."""
