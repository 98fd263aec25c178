"""Operators that prepare text and vectors for training large language models.

Nothing outside this package imports it; it may use general helpers of the library. Each module is one
operator with its own interface; ``queries`` applies them to the given tables.
"""
