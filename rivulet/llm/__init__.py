"""Operators for preparing training data: extraction, scoring, deduplication, packing."""
