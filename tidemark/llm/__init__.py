"""Operators of a training-data pipeline: mixing, dedup, filters, tokens, search."""
