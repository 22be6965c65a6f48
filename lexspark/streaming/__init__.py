"""Resumable and incremental processing by Structured Streaming."""
