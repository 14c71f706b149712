"""Operators of a training-data pipeline: scoring, extraction, dedup, filters, mixing, packing."""
