"""Operators for large-scale training-data preparation, and the queries that apply them to whole tables.

Nothing else in the library imports this subpackage.
"""
