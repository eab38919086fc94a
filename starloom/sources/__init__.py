"""Readers of raw extracts and of published tables."""
