"""Data operators: every one maps DataFrames to a DataFrame and runs no action."""
