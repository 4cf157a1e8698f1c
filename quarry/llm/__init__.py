"""Operators of a training-data pipeline, one module per operator.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
