"""Operators: DataFrame in, DataFrame (or condition) out."""
