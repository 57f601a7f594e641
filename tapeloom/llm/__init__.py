"""Operators for training-data pipelines: scoring, filtering, deduplication, mixing and sharding of corpora.

Nothing outside this subpackage (and `corpus_pipeline.py`) imports it.
"""
