"""Structured Streaming ingest of a drop folder."""
