"""Nested sensor documents -> queryable star schema, on Spark DataFrames."""
