"""Operators for training-data pipelines: languages, pages, vectors, near copies, shards, tokens."""
