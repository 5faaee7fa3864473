"""DataFrame to DataFrame steps of the three layers."""
