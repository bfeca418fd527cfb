"""Structured Streaming forms of the item-stream operators."""
