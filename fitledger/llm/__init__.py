"""Operators for training-data pipelines: extraction, filters, search, mixing, models, duplicates and archives."""
