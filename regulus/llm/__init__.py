"""Operators of a training-data pipeline over documents, pages and embeddings.

Nothing outside this folder and ``corpus_pipeline.py`` imports it. Each module holds one operator with its own interface;
``queries.py`` applies the operators to the given tables.
"""
