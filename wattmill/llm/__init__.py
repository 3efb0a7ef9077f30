"""Operators for preparing training data: cleaning, near-copies, formatting, mixing, tokens, search."""
