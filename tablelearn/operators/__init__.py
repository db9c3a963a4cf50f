"""Table operators. Each function takes and returns DataFrames."""
