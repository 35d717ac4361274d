"""Operators for training-data pipelines (each module: one operator)."""
