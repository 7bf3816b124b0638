"""Daily jobs assembled from operators; each returns the output DataFrame of its table."""
