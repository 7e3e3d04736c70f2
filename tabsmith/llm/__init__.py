"""Operators for preparing a language model's training corpus.

Each module holds one operator with its own general interface; ``queries.py``
binds them to the supplied tables. Nothing outside this package imports it.
"""
