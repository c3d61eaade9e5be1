"""Operators of a training-data pipeline: packing, quality, extraction, dedup, search, encoding."""
