"""Resumable ingestion on Structured Streaming."""
