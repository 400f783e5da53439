"""Scoring of arriving files: stateless, as the batch job."""
