"""Operators of a training-data pipeline: fingerprints, tokenizers, classifiers, deduplication, extraction."""
