"""Operators of a training-data pipeline over tables of documents.

Nothing outside this subpackage and ``corpus_pipeline.py`` imports it.
"""
