"""Operators for text corpora: cleaning, deduplication, tokens, fixity, formatting and sharding."""
