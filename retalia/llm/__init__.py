"""Operators for large training corpora: near-duplicates, packing, sharding, scoring, mixing, search."""
