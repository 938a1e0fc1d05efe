"""DataFrame operators for word counts, product ratings and clustering quality."""
