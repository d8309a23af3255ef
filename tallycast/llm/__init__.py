"""Operators of a training-data pipeline: sharding, deduplication, token counts, mixing, encoding and filters."""
