"""Operators on DataFrames of norms, blocks, versions and events."""
