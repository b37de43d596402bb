"""Operators for training corpora: deduplication, scoring, search, mixing and packing of documents."""
