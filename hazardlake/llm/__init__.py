"""Operators of a training-data pipeline: privacy, quality, deduplication, packing."""
