"""The batch rules on unbounded input."""
