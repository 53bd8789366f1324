"""Operators for training-data corpora, their queries and their SQL twins."""
