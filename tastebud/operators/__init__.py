"""DataFrame operators (DataFrames in, DataFrames out)."""
