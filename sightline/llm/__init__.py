"""Operators for preparing training data (ten operators and the queries that apply them)."""
