"""Operators for building training corpora: filters, de-duplication, tokens, shards."""
