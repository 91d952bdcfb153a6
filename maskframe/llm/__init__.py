"""Operators of a training-data pipeline over web-scale text and vectors.

One module per operator; ``queries`` registers them. Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
