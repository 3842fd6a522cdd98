"""The jobs' building blocks: each takes DataFrames and returns a DataFrame."""
