"""Operators of a training-data pipeline over the ``documents``, ``labels`` and
``pages`` tables.  Nothing outside this package imports it; the registered
queries are in ``queries.py``."""
