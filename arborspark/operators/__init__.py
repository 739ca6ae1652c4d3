"""Operators: every function takes DataFrames and returns DataFrames."""
