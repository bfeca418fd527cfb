"""Column expressions: the hash family and truncating medians."""
