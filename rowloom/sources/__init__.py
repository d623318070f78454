"""Readers and writers. Paths, options and credentials are arguments; nothing is fixed in code."""
