"""Operators for training-data corpora: dedup, sharding, scans, packing, extraction."""
