"""Operators for training-data pipelines.

Each module holds one operator with an interface of its own; ``queries`` applies every one to a
whole given table. Nothing outside this subpackage imports it.
"""
