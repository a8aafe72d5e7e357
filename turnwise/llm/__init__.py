"""Operators of a training-data pipeline. Nothing else in the library imports this package.

``mixing``, ``secrets`` and ``chat`` are built from DataFrame functions alone; the others run
numpy, regular expressions or DuckDB inside Spark tasks on Arrow batches.
"""
