"""Operators of a training-data pipeline: deduplication, packing, mixing, sharding, search, formats."""
