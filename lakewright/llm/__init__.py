"""Operators of a training-data pipeline: filters, classifiers, deduplication and encoding of texts."""
