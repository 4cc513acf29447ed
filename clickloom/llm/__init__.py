"""Operators for training-data pipelines: clean, deduplicate, mix and pack text."""
