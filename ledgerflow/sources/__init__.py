"""Readers, writers, schema and quality checks."""
