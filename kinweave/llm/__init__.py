"""Operators for large-scale training-data preparation.

Nothing else in the library imports this subpackage.  ``registry`` lists its
queries and SQL for the driver entry point.
"""
