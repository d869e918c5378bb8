"""Operators for building training corpora from a ``documents`` table.

Each module holds one operator with its own general interface; ``queries``
registers the thin contract queries over the whole table.  Nothing outside this
subpackage imports it.
"""
