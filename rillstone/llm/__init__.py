"""Operators for preparing training text: dedup, encoding, extraction, scoring, privacy and packing."""
