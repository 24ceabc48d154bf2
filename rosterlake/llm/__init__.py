"""Operators for preparing training text: search, scoring, packing, extraction, deduplication."""
