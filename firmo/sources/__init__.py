"""Scans and sinks."""

from firmo.sources.tables import table  # noqa: F401
