"""Column expressions: times, keys and names."""
