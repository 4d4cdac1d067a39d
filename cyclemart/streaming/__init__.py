"""Incremental arrival of source files."""
