"""Operators of a training-data pipeline: scoring, fingerprints, extraction, mixing, tokenising, deduplication.

Nothing else in the library imports this subpackage. ``llm.catalog`` registers one query
per operator; ``corpus_pipeline.py`` at the repository top chains five of them.
"""
