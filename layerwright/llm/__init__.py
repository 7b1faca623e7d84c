"""Operators for preparing training data: deduplication, formatting, counting, mixing, filtering, search."""
