"""Training-data operators: deduplication, search, chat formatting, language models,
tokenisation, language ID, packing and secret scans.

Nothing outside this subpackage imports it.  ``queries`` registers one query per
operator; ``corpus_pipeline.py`` at the repository top chains five of them.
"""
