"""Structured Streaming forms of ingest and deduplication, and batch functions."""
