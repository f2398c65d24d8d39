"""Operators for training-data pipelines on documents, vectors and web pages.

Nothing outside this package, ``corpus_pipeline`` and ``tests/llm`` imports it.
"""
