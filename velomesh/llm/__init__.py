"""Operators for preparing training data: identification, deduplication, mixing, tokens, privacy, search."""
