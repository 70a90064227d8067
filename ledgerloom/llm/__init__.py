"""Operators for preparing training text: filters, deduplication, search, tokenizing and packing."""
