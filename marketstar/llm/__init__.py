"""Operators for preparing training text: filters, mixing, fingerprints, dedup, sharding, scoring, search, packing."""
