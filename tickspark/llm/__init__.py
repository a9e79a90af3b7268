"""Operators for large-scale training-data preparation, with their queries.

Nothing else in the library imports this subpackage. The operators take frames and column
names; ``queries`` applies each of them to its whole table.
"""
