"""Operators for large text collections: filters, deduplication, tokens, packing and web archives."""
