"""Operators for preparing training text: filters, mixing, formats, duplicates, contamination, token files."""
