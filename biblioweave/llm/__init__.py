"""Operators of a training-data pipeline: fingerprints, dedup, filters, classifiers, formatting, packing."""
