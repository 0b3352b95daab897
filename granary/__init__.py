"""Spark-first data-quality and training-data engine."""
