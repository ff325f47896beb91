"""Whole jobs: building the lake, and the report queries over it."""
