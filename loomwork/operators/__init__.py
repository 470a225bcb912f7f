"""Steps the plans are made of, each a function from DataFrames to a DataFrame."""
