"""Operators of a training-data pipeline (deduplication, quality, mixing, ...).

Nothing else in the library imports this subpackage.
"""
