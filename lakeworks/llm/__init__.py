"""Training-data operators: dedup, similarity joins, tokenising, formatting,
classification, search, sharding and packing of text corpora.

Nothing outside this folder, ``corpus_pipeline.py`` and ``tests/llm`` imports
this subpackage.
"""
