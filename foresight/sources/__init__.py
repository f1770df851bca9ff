"""Readers and writers: plant tables, stage tables, logs, JSON requests, content versions."""
