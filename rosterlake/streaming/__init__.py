"""Structured Streaming form of the insert-time checks."""
