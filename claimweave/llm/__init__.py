"""Operators for training-data pipelines: deduplication, packing, scoring, search, tokenization."""
