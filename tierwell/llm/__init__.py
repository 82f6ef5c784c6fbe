"""Operators of a training-data pipeline: quality, dedup, mixing, packing, search and language ID.

Each module holds one operator with its general interface; ``queries`` registers them over the
given tables. Nothing outside this package imports it.
"""
