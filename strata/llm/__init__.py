"""Operators of a training-data pipeline (dedup, quality, mixing, tokens).

Nothing outside this folder imports it; see ``queries.py`` for what is
registered and ``corpus_pipeline.py`` for the pipeline built from it.
"""
