"""Operators of a training-data pipeline: filters, deduplication, scans, mixing, sharding and packing.

Nothing outside this subpackage (and ``corpus_pipeline.py``, which belongs to it) imports it.
"""
