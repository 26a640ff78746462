"""Incremental runs over files as they arrive."""
