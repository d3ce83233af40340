"""Operators for building training corpora: filtering, deduplication, mixing, archives.

Nothing outside this package imports it. `queries` registers one query for each
operator over the given tables.
"""
