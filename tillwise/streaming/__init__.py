"""Structured Streaming queries over the order stream."""
