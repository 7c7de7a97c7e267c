"""Operators of a training-data pipeline: scans, filters, deduplication, mixing and sharding of text."""
