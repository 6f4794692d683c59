"""Relational operators over DataFrames (cleaning, joins, windows, aggregates,
top-k, set operations, quality checks, profiling, enrichment, edits)."""
