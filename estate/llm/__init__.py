"""Operators of a large-scale training-data pipeline.

Each module is one operator by one method.  Nothing else in the library imports this package.
"""
