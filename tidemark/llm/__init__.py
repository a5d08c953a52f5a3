"""Operators for training-data pipelines: deduplication, scoring, packing, extraction, sharding.

Nothing outside this package imports it. ``tidemark.llm.queries`` holds the registered queries.
"""
