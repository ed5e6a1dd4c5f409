"""Operators composed into the published tables and the recurring jobs."""
