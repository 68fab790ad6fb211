"""Splits, models, evaluation and the model registry."""
