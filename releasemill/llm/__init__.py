"""Operators of a training-data pipeline: deduplication, filters, tokens, scoring, sharding."""
