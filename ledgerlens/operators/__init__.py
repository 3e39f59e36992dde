"""Joins, grouped statistics, ordered features, validation and evaluation on DataFrames."""
