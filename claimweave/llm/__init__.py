"""Operators for preparing training text: filtering, deduplication, privacy, tokens and shards."""
