"""Operators that prepare training data: language, shards, duplicates, filters, tokens."""
