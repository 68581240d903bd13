"""DataFrame operators: each takes DataFrames and names and returns a lazy DataFrame."""
