"""Operators for preparing training data at scale.

Each module holds one operator with its own general interface; ``queries.py``
derives the registered digest columns from them.  Nothing outside this
subpackage imports it, except the guarded entry file.
"""
