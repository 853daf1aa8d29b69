"""Operators that prepare text for language-model training.

Nothing else in the library imports this package. Every operator takes DataFrames and returns
DataFrames; the registered queries are in ``queries.py``.
"""
