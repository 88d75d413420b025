"""Operators for training data: filters, deduplication, mixing, tokenising and packing of large text corpora."""
