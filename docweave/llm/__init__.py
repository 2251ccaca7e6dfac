"""Operators for preparing text corpora: deduplication, filters, scores, tokens and packing."""
