"""Operators for large text corpora, one module each, and their queries."""
