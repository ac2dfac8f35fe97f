"""Operators of a training-data pipeline: scoring, deduplication, filtering, mixing."""
