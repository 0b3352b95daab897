"""Operators of the data-quality engine."""
