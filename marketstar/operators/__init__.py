"""Reusable DataFrame operators: reshape, quality/coverage, joins."""
