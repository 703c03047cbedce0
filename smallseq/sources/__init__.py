"""File formats as DataFrames."""
