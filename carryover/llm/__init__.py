"""Operators for training-data pipelines, one module each.

Nothing else in the library imports this subpackage.  Each module's
docstring says what it computes, how it behaves at scale and what it
returns for nulls, empty and very long texts, ties, repeated rows and
empty tables.  ``queries.py`` binds them to the given tables.
"""
