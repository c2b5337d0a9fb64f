"""Incremental processing of newly landed dates with Structured Streaming."""
