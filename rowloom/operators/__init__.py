"""Operators from DataFrames to DataFrames. They plan work and run none."""
