"""Corpus operators for training data: deduplication, formatting, tokens, shards, secrets, quality, mixing, vectors and pages."""
