"""Relational operators: DataFrames in, one DataFrame out."""
