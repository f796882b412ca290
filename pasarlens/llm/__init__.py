"""Operators for preparing training corpora: deduplication, filtering, mixing, sharding, packing."""
