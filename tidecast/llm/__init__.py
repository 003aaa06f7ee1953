"""Operators of a training-data pipeline: ten corpus operators and their queries.

Nothing else in the package imports this subpackage.  ``catalog.QUERIES`` and
``catalog.ORACLE`` hold what ``__spark_entry__`` registers.
"""
