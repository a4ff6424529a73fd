"""Operators of a training-data pipeline over documents, vectors, conversations and token ids."""
