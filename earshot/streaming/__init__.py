"""Structured Streaming jobs: record ingest into keyed state, incremental loads."""
