"""Operators of a training-data pipeline: texts, pages, vectors and token ids.

Nothing else in the library imports this subpackage.
"""
