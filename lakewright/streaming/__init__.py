"""Incremental ingestion of files as they arrive."""
