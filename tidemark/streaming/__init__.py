"""Structured Streaming operators and writers."""
