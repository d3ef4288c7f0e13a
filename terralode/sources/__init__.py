"""Readers: paths to DataFrames."""
