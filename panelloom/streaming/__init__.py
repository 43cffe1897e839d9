"""Incremental landing of new raw files."""
