"""Operators for large-scale training-data preparation, and the queries that apply them.

Nothing else in the library imports this subpackage; it imports nothing from the rest either.
"""
