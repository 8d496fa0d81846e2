"""Operators for preparing training corpora.

Nothing outside this package imports it. Every operator is a function over
DataFrames; the registered queries are thin wrappers in ``queries.py``.
"""
