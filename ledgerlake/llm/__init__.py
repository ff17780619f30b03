"""Operators of a training-data pipeline: filters, near duplicates, tokens, packing.

Nothing else in the library imports this subpackage. Each module holds one
operator with its general interface; ``registry`` derives the registered
queries from them.
"""
