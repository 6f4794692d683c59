"""Incremental landing of new source files with Structured Streaming."""
