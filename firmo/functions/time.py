"""Timestamp parsing with several accepted spellings."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

# The two accepted spellings (with and without a fraction).
TS_FORMATS = ("yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "yyyy-MM-dd'T'HH:mm:ss")


def parse_timestamp_multi(c, fallback: dt.datetime, formats=TS_FORMATS) -> Column:
    """First format that parses, else ``fallback``; result is ``timestamp_ntz``."""
    x = F.nullif(F.trim(F.col(c) if isinstance(c, str) else c), F.lit(""))
    tries = [F.try_to_timestamp(x, F.lit(f)).cast("timestamp_ntz") for f in formats]
    return F.coalesce(*tries, F.lit(fallback.isoformat(sep=" ")).cast("timestamp_ntz"))
