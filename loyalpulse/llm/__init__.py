"""Operators for building training data: deduplication, scans, search, packing, mixing.

Nothing else in the library imports this package.
"""
