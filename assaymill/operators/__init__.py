"""Operators: each takes DataFrames plus column names and returns a DataFrame."""
