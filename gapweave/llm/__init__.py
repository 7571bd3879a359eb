"""Operators for training-data pipelines: extraction, tokens, packing, quality, near duplicates.

Nothing outside this package imports it.
"""
