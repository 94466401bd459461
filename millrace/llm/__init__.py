"""Operators for preparing training text: scanning, deduplication, classification and mixing."""
