"""Operators for large text collections: scoring, filtering, deduplication, encoding, sharding."""
