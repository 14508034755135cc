"""Structured Streaming variants of the incremental jobs."""
