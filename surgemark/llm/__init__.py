"""Operators for preparing training text: quality, toxicity, duplicates, tokens, packing."""
