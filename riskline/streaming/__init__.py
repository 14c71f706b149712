"""Structured Streaming versions of the windowed, scoring and dedup operators."""
