"""Deterministic writers: the same table gives the same bytes."""
