"""Structured Streaming forms of the scoring paths."""
