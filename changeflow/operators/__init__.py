"""Operators: DataFrame → DataFrame transformations."""
