"""Operators for training-data pipelines: filters, near-duplicates, packing, language models.

Nothing else in the library imports this package.
"""
