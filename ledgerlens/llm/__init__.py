"""Operators for large training corpora: formatting, packing, mixing, rules, dedup, licences, sharding, scoring.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
