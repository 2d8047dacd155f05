"""Operators for preparing training data: deduplication, scoring, search, encoding and archives."""
