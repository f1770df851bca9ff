"""Structured Streaming jobs over request and prediction logs; each one has a batch twin."""
