"""Operators of a training-data pipeline (packing, dedup, scoring, search, mixing).

Nothing else in the library imports this subpackage. ``catalog.QUERIES`` and
``oracle.ORACLE_SQL`` hold its registered queries.
"""
