"""Continuous forms of the load and of the picking-time pairing."""
