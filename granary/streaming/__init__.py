"""Streaming of the data-quality engine."""
