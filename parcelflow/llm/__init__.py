"""Operators of a training-data pipeline on Spark.

Each module holds one operator with its own general interface; ``queries.py``
registers the thin queries over the given tables.  Nothing outside this folder
imports it, except the guarded registration in ``__spark_entry__.py``.
"""
