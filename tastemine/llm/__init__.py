"""Operators of a training-data pipeline: scanning, deduplication, quality, mixing and packing of documents."""
