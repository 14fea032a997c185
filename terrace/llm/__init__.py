"""Operators for training-data pipelines over ``documents``-like tables.

One module per operator. Nothing outside this package imports it.
"""
