"""Operators for preparing training text: filters, dedupe, packing, formatting, sharding."""
