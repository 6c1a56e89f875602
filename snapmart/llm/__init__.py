"""Operators for large training-data pipelines. Nothing outside this folder and `corpus_pipeline.py` imports them."""
