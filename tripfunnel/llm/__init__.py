"""Operators for preparing training data: scoring, filters, deduplication, packing, sharding."""
