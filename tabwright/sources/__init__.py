"""Readers, writers, saved models and the run table."""
