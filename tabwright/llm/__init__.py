"""Operators for the preparation of text corpora. Nothing outside this package imports it."""
