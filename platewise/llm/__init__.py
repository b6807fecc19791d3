"""Operators for training-data pipelines: tokenising, deduplication, classifiers, fingerprints, filters."""
