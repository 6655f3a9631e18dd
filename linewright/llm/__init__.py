"""Operators for large text corpora: formatting, filters, deduplication, tokens.

Nothing else in the library imports this subpackage.
"""
