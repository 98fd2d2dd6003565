"""Operators for preparing training data: quality, deduplication, extraction, packing."""
