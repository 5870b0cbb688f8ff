"""Batch sources: the driver-table adapters and file/table readers."""
