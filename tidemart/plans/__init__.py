"""The warehouse jobs: pure functions from DataFrames (and a day) to a DataFrame."""
