"""Operators for training data: deduplication, extraction, scoring, formatting, tokens."""
