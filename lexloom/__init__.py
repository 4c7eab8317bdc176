"""Lexloom: versioned-document histories and training-corpus preparation on Spark DataFrames."""
