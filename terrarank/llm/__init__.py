"""Operators for preparing training text; each takes and returns DataFrames."""
