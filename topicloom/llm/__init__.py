"""Operators and the corpus pipeline for preparing training data."""
