"""Operators for training-data pipelines: dedup, archives, mixing, sharding, classifiers, tokens."""
