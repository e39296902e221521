"""Reusable DataFrame operators: each one is a function from DataFrames to a DataFrame."""
