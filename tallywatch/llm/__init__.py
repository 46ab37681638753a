"""Operators of a training-data pipeline: fingerprints, search, deduplication, packing, filters, extraction."""
