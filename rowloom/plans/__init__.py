"""Whole pipelines: read, apply operators, write."""
