"""Text cleaning expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The country alias map of the ingestion step (keys already
# upper-cased and trimmed).  "U.S." is deliberately absent, as in the source.
COUNTRY_ALIASES = {
    "US": "USA",
    "UNITED STATES": "USA",
    "UNITED STATES OF AMERICA": "USA",
    "UK": "UK",
    "UNITED KINGDOM": "UK",
}

# Tokens that count as "missing" text besides null.
MISSING_TOKENS = ("", "None")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip_ws(c) -> Column:
    """Strip all leading/trailing whitespace (``trim`` strips spaces only)."""
    return F.regexp_replace(F.regexp_replace(_c(c), r"^\s+", ""), r"\s+$", "")


def upper_trim(c) -> Column:
    return F.trim(F.upper(_c(c)))


def blank_to_null(c) -> Column:
    """``nullif(trim(x), '')``."""
    return F.nullif(F.trim(_c(c)), F.lit(""))


def is_missing_text(c) -> Column:
    """Null, ``''`` or ``'None'`` (the ingestion's notion of a missing field)."""
    col = _c(c).cast("string")
    return col.isNull() | col.isin(*MISSING_TOKENS)


def clean_domain(c) -> Column:
    """lower, strip, drop ``http(s)://``, ``www.`` and any path."""
    x = F.lower(strip_ws(c))
    x = F.regexp_replace(x, r"^https?://", "")
    x = F.regexp_replace(x, r"^www\.", "")
    return F.split(x, "/", 2).getItem(0)


def extract_host(c) -> Column:
    """As :func:`clean_domain` but case kept and ``:port`` dropped; null for empty input."""
    x = _c(c)
    y = F.regexp_replace(F.regexp_replace(x, r"^https?://", ""), r"^www\.", "")
    y = F.split(F.split(y, "/", 2).getItem(0), ":", 2).getItem(0)
    return F.when(x.isNull() | (x == ""), F.lit(None).cast("string")).otherwise(y)


def clean_country(c, aliases: dict | None = None) -> Column:
    """upper + strip, then alias replace.  The map is a parameter."""
    amap = COUNTRY_ALIASES if aliases is None else aliases
    x = F.upper(strip_ws(c))
    if not amap:
        return x
    lookup = F.create_map(*[F.lit(v) for kv in sorted(amap.items()) for v in kv])
    return F.coalesce(F.try_element_at(lookup, x), x)


def title_case(c) -> Column:
    """First letter of each space-separated word upper, rest lower."""
    return F.initcap(F.lower(_c(c)))


def label_truncate(c, n: int, default: str = "Unknown") -> Column:
    return F.substring(F.coalesce(F.nullif(_c(c), F.lit("")), F.lit(default)), 1, n)
