"""Operators of a training-data pipeline (dedup, tokens, mixing, search)."""
