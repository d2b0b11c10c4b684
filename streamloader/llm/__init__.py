"""Operators of a training-data pipeline: packing, privacy, sharding, quality, scoring and deduplication."""
