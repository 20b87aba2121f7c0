"""Table operators: each takes and returns DataFrames."""
