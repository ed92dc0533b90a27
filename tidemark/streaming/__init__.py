"""Structured Streaming queries over landed files and stored tables."""
