"""Readers and writers: JSON lines, CSV, columnar files, stage folders, configuration."""
