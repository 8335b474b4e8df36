"""Operators for preparing training text: language, near duplicates, quality, personal data, packing."""
