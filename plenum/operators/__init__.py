"""Operators: DataFrames in, DataFrame out, lazy unless an algorithm iterates."""
