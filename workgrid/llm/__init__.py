"""Operators for large-scale text corpora: cleaning, deduplication, tokenization, search."""
