"""Operators for building training corpora: tokens, quality, secrets, mixing, filters and deduplication."""
