"""Operators for training data: deduplication, tokens, archives, filters and packing."""
