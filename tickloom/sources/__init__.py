"""Schemas, readers, writers and table adapters."""
