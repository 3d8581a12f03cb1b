"""Whole jobs: publish, look up, verify, update."""
