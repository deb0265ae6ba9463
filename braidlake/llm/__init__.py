"""Operators for training-data pipelines: scoring, near duplicates, mixing, sharding, packing."""
