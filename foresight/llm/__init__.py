"""Operators for large text and embedding collections; nothing else in the library imports this package."""
