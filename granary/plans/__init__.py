"""Plans of the data-quality engine."""
