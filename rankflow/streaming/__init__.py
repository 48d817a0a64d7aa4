"""Structured Streaming: incremental snapshot ingest that writes each key once."""
