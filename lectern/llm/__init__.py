"""Operators for preparing training text: deduplication, quality, secrets, licences, packing, tokens."""
