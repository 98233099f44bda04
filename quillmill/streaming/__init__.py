"""Incremental ingest of newly arrived pages."""
