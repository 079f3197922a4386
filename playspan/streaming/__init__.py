"""Incremental loads from landing folders."""
