"""Operators for large text corpora, one module each, and their queries in `catalog`.

Nothing else in the library imports this package.
"""
