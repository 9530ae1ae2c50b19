"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage. ``llm.queries`` registers one
query per operator; each operator's module states its results for nulls, empty
texts, ties, repeated rows, empty tables and extra columns.
"""
