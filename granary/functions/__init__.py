"""Functions of the data-quality engine."""
