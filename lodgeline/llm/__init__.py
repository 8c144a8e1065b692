"""Operators of a training-data pipeline: scoring, extraction, sharding, near duplicates, tokens, packing."""
