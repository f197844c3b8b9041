"""Structured Streaming forms of the scoring query."""
