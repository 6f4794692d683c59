"""Numeric parsing and display formatting."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def coerce_numeric(c, to: str = "double") -> Column:
    """Text -> number; anything unparsable becomes null (never raises).  Only plain
    and exponent notation and infinity are numbers: no type suffixes (``12d``), no
    hexadecimals, and ``NaN`` is a missing value."""
    x = F.trim(_c(c).cast("string"))
    return F.when(x.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$") | x.rlike(r"(?i)^[+-]?inf(inity)?$"), x).try_cast(to)


def format_number(c) -> Column:
    """Thousands separators, ``-`` for null/NaN (integers; fractions rounded to 3 places)."""
    x = _c(c).cast("double")
    whole = F.format_number(x, 0)
    frac = F.regexp_replace(F.format_number(x, 3), r"\.?0+$", "")
    body = F.when(x == F.floor(x), whole).otherwise(frac)
    return F.when(x.isNull() | F.isnan(x), F.lit("-")).otherwise(body)


def format_currency(c) -> Column:
    """``1.5B`` / ``250.3M`` / ``45.2K``; below 1000 thousands-separated; ``-`` for null."""
    x = _c(c).cast("double")

    def suffix(div: float, s: str) -> Column:
        return F.concat(F.format_string("%.1f", x / F.lit(div)), F.lit(s))

    return (F.when(x.isNull() | F.isnan(x), F.lit("-"))
             .when(x >= 1e9, suffix(1e9, "B"))
             .when(x >= 1e6, suffix(1e6, "M"))
             .when(x >= 1e3, suffix(1e3, "K"))
             .otherwise(format_number(x)))


def parse_year(c) -> Column:
    """First 4-digit run as an int, else null."""
    y = F.regexp_extract(_c(c), r"(\d{4})", 1)
    return F.nullif(y, F.lit("")).try_cast("int")


def parse_count(c) -> Column:
    """First integer after removing thousands commas, else null."""
    n = F.regexp_extract(F.regexp_replace(_c(c), ",", ""), r"(\d+)", 1)
    return F.nullif(n, F.lit("")).try_cast("long")


def parse_revenue_text(c) -> Column:
    """``US$ 391 billion`` -> 3.91e11.

    Digits, dots and commas are kept, commas dropped; ``billion``/``bn``
    scale by 1e9, else ``million``/``mn`` or any ``m`` by 1e6."""
    v = _c(c)
    kept = F.regexp_replace(v, r"[^\d.,]", "")
    num = F.regexp_replace(F.regexp_extract(kept, r"([\d.,]+)", 1), ",", "")
    x = F.nullif(num, F.lit("")).try_cast("double")
    low = F.lower(v)
    scale = (F.when(low.contains("billion") | low.contains("bn"), F.lit(1e9))
              .when(low.contains("million") | low.contains("mn") | low.contains("m"), F.lit(1e6))
              .otherwise(F.lit(1.0)))
    return x * scale
