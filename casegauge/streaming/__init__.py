"""Structured Streaming pipelines over dropped sample files."""
