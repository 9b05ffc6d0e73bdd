"""Structured Streaming: landing ingestion, keyed appends, late-data rebuilds."""
