"""Structured Streaming ingest and live rollups."""
