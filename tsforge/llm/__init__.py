"""Operators of a training-data pipeline over ``documents``-like tables.

Nothing else in the package imports this one. Each module holds one operator with its own general
interface; ``queries`` derives the registered result columns from the operators' outputs.
"""
