"""DataFrame-in, DataFrame-out operations."""
