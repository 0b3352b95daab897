"""Sources of the data-quality engine."""
