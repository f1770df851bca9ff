"""Relational building blocks: windows, as-of lookups, splits, validation, metrics, drift statistics."""
