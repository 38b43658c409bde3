"""Structured Streaming jobs: Bronze ingestion and the JSON row processor."""
