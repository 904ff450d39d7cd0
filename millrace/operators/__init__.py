"""Transforms over DataFrames: every function takes and returns DataFrames (or columns)."""
