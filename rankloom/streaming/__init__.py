"""Structured Streaming over arriving files."""
