"""Operators for preparing training data: filters, deduplication, mixing, tokens, archives and sharding."""
