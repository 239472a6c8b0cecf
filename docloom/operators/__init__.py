"""Operators of the change pipeline; every function takes and returns lazy DataFrames."""
