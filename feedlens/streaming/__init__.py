"""Structured Streaming ingest, dedupe and upsert."""
