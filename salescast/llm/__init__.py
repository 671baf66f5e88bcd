"""Operators of a training-data pipeline on the documents and embeddings tables."""
