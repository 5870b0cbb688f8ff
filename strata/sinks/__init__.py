"""Batch sinks: files, tables and the external Gold contract."""
