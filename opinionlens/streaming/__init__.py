"""Incremental work."""
