"""Operators on DataFrames of records."""
