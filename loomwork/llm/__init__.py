"""Operators of a training-data pipeline over documents, pages, conversations and embeddings."""
