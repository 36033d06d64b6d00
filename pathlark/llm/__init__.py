"""Operators for preparing training text: deduplication, filtering, scanning, tokenising."""
