"""Structured Streaming jobs. Every job takes a streaming DataFrame and returns one, or starts a
query with its own checkpoint."""
