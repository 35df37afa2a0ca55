"""Streaming forms of audit operators."""
