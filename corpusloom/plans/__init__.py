"""Whole pipelines from files to files."""
