"""Relational curation operators: DataFrames in, lazy DataFrames out."""
