"""Structured Streaming: incremental CSV ingest and incremental append."""
