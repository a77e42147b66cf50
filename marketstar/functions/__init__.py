"""Column-level expressions and the named metric/filter registry."""
