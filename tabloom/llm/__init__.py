"""Operators for preparing training text: deduplication, scanning, extraction, filtering, packing, mixing."""
