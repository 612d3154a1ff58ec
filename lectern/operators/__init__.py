"""Operators: ``fn(df, ..., **params) -> DataFrame``."""
