"""Structured Streaming front-end."""
