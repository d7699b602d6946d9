"""Operators for large training-data corpora (filters, near-duplicates, packing, scoring, search)."""
