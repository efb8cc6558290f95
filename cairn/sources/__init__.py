"""Readers: test-data inputs, files with declared schemas, catalog tables, streams."""
