"""Incremental ingest of newly arrived skeleton files."""
