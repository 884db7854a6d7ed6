"""Operators of a training-data pipeline: quality, deduplication, tokens, filters, search, mixing.

Nothing else in the library imports this subpackage. ``queries`` registers one query per operator.
"""
