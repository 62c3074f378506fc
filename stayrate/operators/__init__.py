"""DataFrame operators. Each takes and returns DataFrames, stays lazy and collects nothing."""
