"""Composed plans: fixtures, the end-to-end run and the query registry."""
