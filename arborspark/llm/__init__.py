"""Operators of a training-data pipeline over text, conversations, web archives and embeddings."""
