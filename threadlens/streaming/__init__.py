"""Structured Streaming twins of the ingest and cleaning operators."""
