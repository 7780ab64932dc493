"""DataFrame operators from normalisation to search, checks and metrics."""
