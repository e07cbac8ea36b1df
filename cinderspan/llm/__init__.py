"""Operators for large text corpora: duplicates, tokens, quality, archives and packing."""
