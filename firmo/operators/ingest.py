"""Ingestion: bring a source to the unified schema and clean it (O-PR-01..05)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from firmo.functions.numeric import coerce_numeric
from firmo.functions.text import clean_country, clean_domain, strip_ws
from firmo.schemas import UNIFIED_FIELDS

# Accepted header names (lower-cased) and the unified field each maps to,
# in the order of the alias table.
COLUMN_ALIASES = [
    ("name", "company_name"), ("company", "company_name"), ("company_name", "company_name"),
    ("website", "domain"), ("url", "domain"), ("domain", "domain"),
    ("industry", "industry"), ("sector", "industry"), ("industry_type", "industry"),
    ("country", "country"), ("country_code", "country"), ("location", "country"),
    ("employees", "employee_count"), ("employee_count", "employee_count"), ("num_employees", "employee_count"),
    ("revenue", "revenue"), ("revenues", "revenue"), ("annual_revenue", "revenue"),
    ("founded", "founded_year"), ("founded_year", "founded_year"), ("year_founded", "founded_year"),
    ("established", "founded_year"),
]


def normalize_schema(df: DataFrame, source_name: str, loaded_at: dt.datetime,
                     extra_aliases: list[tuple[str, str]] | None = None) -> DataFrame:
    """O-PR-01: map source columns to the 7 unified fields by alias (case-insensitive,
    trimmed), add absent fields as null, tag source and load time, fixed order.

    When several source columns map to one field (``industry`` and ``sector``),
    the first non-null in alias-table order wins (quirk Q11).  Only the
    projection is planned on the driver; no data moves."""
    aliases = COLUMN_ALIASES + list(extra_aliases or [])
    present = {c.strip().lower(): c for c in df.columns}
    cols = []
    for field in UNIFIED_FIELDS:
        srcs = [present[a] for a, f in aliases if f == field and a in present]
        srcs = list(dict.fromkeys(srcs))
        if not srcs:
            cols.append(F.lit(None).cast("string").alias(field))
        elif len(srcs) == 1:
            cols.append(F.col(f"`{srcs[0]}`").alias(field))
        else:
            cols.append(F.coalesce(*[F.col(f"`{s}`").cast("string") for s in srcs]).alias(field))
    return df.select(*cols, F.lit(source_name).alias("source_system"),
                     F.lit(loaded_at.isoformat()).alias("last_updated_at"))


def ingest_clean(df: DataFrame, country_aliases: dict | None = None) -> DataFrame:
    """O-PR-02/04/05: strip names, clean domains, normalise countries, numbers from text.

    Nulls stay null (the source turned them into the text 'nan'/'None', Q10)."""
    return (df.withColumn("company_name", strip_ws(F.col("company_name").cast("string")))
              .withColumn("domain", clean_domain(F.col("domain").cast("string")))
              .withColumn("country", clean_country(F.col("country").cast("string"), country_aliases))
              .withColumn("employee_count", coerce_numeric("employee_count"))
              .withColumn("revenue", coerce_numeric("revenue"))
              .withColumn("founded_year", coerce_numeric("founded_year")))
