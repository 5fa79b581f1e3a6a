"""Operators of a training-data pipeline: language, packing, scoring, duplicates, secrets, leaks, quality, archives, PII.

Nothing outside this package imports it, except the guarded import in ``__spark_entry__.py``
and ``corpus_pipeline.py``.
"""
