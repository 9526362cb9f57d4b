"""Incremental runs of the batch operators on Structured Streaming."""
