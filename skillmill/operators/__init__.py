"""Relational operators over DataFrames: upsert, lookup, checks."""
