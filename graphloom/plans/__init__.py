"""Algebra to DataFrames."""
