"""Readers: event tables, JSON files, stream envelopes, the test-table overlay."""
