"""Operators for training-data corpora.

Each module holds one operator with a general interface; ``queries`` registers
one query per operator over the given tables. Nothing outside this subpackage
imports it.
"""
