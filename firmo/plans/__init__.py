"""Composite models: the raw, bronze and mart layers as lazy DataFrames."""
