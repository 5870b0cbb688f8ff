"""Structured Streaming: keyed topic and the Bronze ingest."""
