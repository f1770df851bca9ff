"""Composite jobs: features, training, scoring, monitoring, retraining."""
