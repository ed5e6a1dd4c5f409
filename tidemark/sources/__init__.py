"""Readers for files, external stores and the message log."""
