"""Table operators: DataFrames and plain settings in, DataFrames out."""
