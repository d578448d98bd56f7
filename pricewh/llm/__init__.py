"""Training-data operators: deduplication, filters, tokenising, packing, scoring.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
