"""Projection and cleaning steps of the layers (O-PR-*)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from firmo.functions.keys import company_key, metric_key
from firmo.functions.text import blank_to_null, is_missing_text
from firmo.functions.time import parse_timestamp_multi
from firmo.params import DEFAULT, RunParams
from firmo.schemas import RAW_FCT_COLUMNS

# Source labels written by the models.
PRIMARY_SOURCE = "kaggle: https://www.kaggle.com/datasets/jeannicolasduval/2024-fortune-1000-companies"
SECONDARY_DEFAULT_SOURCE = "global_companies"
FACT_SOURCE = "fortune1000"
UNKNOWN = "UNKNOWN"


def _ts(p: RunParams):
    return F.lit(p.run_ts.isoformat(sep=" ")).cast("timestamp_ntz")


def _nonblank(c: str):
    return F.col(c).isNotNull() & (F.trim(F.col(c)) != "")


def primary_dim_project(stg: DataFrame, p: RunParams = DEFAULT) -> DataFrame:
    """Primary source as dimension rows (O-PR-06/07): keys, blanks to null, typed null columns."""
    return (stg.filter(_nonblank("company"))
            .select(company_key("company", "country").alias("company_id"),
                    F.trim(F.upper("company")).alias("company_name"),
                    blank_to_null("ticker").alias("ticker"),
                    blank_to_null("sector").alias("sector"),
                    blank_to_null("industry").alias("industry"),
                    blank_to_null("industry").alias("industry_primary"),
                    F.lit(None).cast("string").alias("industry_secondary"),
                    blank_to_null(F.upper("country")).alias("country"),
                    blank_to_null("headquarterscity").alias("headquarters_city"),
                    blank_to_null("headquartersstate").alias("headquarters_state"),
                    blank_to_null("ceo").alias("ceo"),
                    blank_to_null("website").alias("website"),
                    F.lit(None).cast("int").alias("founded_year"),
                    F.lit(None).cast("int").alias("employee_count"),
                    F.lit(None).cast("double").alias("revenue"),
                    F.lit(PRIMARY_SOURCE).alias("source_system"),
                    _ts(p).alias("loaded_at")))


def secondary_dim_project(stg: DataFrame, p: RunParams = DEFAULT) -> DataFrame:
    """Secondary source as dimension rows; load time parsed from two spellings (O-PR-08)."""
    return (stg.filter(_nonblank("company_name") & _nonblank("country"))
            .select(company_key("company_name", "country").alias("company_id"),
                    F.trim(F.upper("company_name")).alias("company_name"),
                    F.lit(None).cast("string").alias("ticker"),
                    F.lit(None).cast("string").alias("sector"),
                    blank_to_null("industry").alias("industry"),
                    blank_to_null("industry").alias("industry_primary"),
                    F.lit(None).cast("string").alias("industry_secondary"),
                    blank_to_null(F.upper("country")).alias("country"),
                    F.lit(None).cast("string").alias("headquarters_city"),
                    F.lit(None).cast("string").alias("headquarters_state"),
                    F.lit(None).cast("string").alias("ceo"),
                    blank_to_null("domain").alias("website"),
                    F.col("founded_year").cast("int").alias("founded_year"),
                    F.lit(None).cast("int").alias("employee_count"),
                    F.lit(None).cast("double").alias("revenue"),
                    F.coalesce(blank_to_null("source_system"), F.lit(SECONDARY_DEFAULT_SOURCE)).alias("source_system"),
                    parse_timestamp_multi("last_updated_at", p.run_ts).alias("loaded_at")))


def default_unknown(df: DataFrame) -> DataFrame:
    """O-PR-09: null ticker/sector/country -> UNKNOWN; industry falls back to the primary industry."""
    return (df.withColumn("ticker", F.coalesce("ticker", F.lit(UNKNOWN)))
              .withColumn("sector", F.coalesce("sector", F.lit(UNKNOWN)))
              .withColumn("industry", F.coalesce("industry", "industry_primary", F.lit(UNKNOWN)))
              .withColumn("country", F.coalesce("country", F.lit(UNKNOWN))))


def raw_fct_project(stg: DataFrame, p: RunParams = DEFAULT) -> DataFrame:
    """O-PR-10: metrics with null -> 0, revenue millions -> dollars, date defaults to as-of."""
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    return (stg.filter(_nonblank("company"))
            .select(metric_key("company", "ticker", "country").alias("company_id"),
                    F.trim(F.upper("company")).alias("company_name"),
                    F.coalesce("rank", F.lit(0)).cast("long").alias("fortune_rank"),
                    F.coalesce("number_of_employees", F.lit(0)).cast("long").alias("employee_count"),
                    (F.coalesce("revenues_m", F.lit(0.0)) * F.lit(1000000)).cast("double").alias("revenue_millions"),
                    z("revenuepercentchange").cast("double").alias("revenue_percent_change"),
                    z("profits_m").cast("double").alias("profits_m"),
                    z("profitspercentchange").cast("double").alias("profits_percent_change"),
                    z("assets_m").cast("double").alias("assets_m"),
                    z("marketcap_march28_m").cast("double").alias("market_cap_march_m"),
                    z("marketcap_updated_m").cast("double").alias("market_cap_updated_m"),
                    F.coalesce("updated", F.lit(p.as_of_date)).alias("metric_date"),
                    F.lit(FACT_SOURCE).alias("source_system"),
                    _ts(p).alias("loaded_at"))
            .select(*RAW_FCT_COLUMNS))


def bronze_dim_clean(raw_dim: DataFrame, p: RunParams = DEFAULT) -> DataFrame:
    """O-PR-11: upper/trim/lower, UNKNOWN country -> null, founded year in 1800..as-of year."""
    fy = F.col("founded_year")
    return (raw_dim.filter(F.col("company_name").isNotNull() & (F.length(F.trim("company_name")) > 0))
            .select("company_id",
                    F.trim(F.upper("company_name")).alias("company_name"),
                    F.when(_nonblank("ticker"), F.upper(F.trim("ticker"))).alias("ticker"),
                    blank_to_null("sector").alias("sector"),
                    F.coalesce(blank_to_null("industry"), blank_to_null("industry_primary"), F.lit(UNKNOWN)).alias("industry"),
                    blank_to_null("industry_primary").alias("industry_primary"),
                    F.when(F.col("country").isNotNull() & (F.upper(F.trim("country")) != UNKNOWN),
                           F.upper(F.trim("country"))).alias("country"),
                    blank_to_null("headquarters_city").alias("headquarters_city"),
                    blank_to_null("headquarters_state").alias("headquarters_state"),
                    blank_to_null("ceo").alias("ceo"),
                    F.when(_nonblank("website"), F.lower(F.trim("website"))).alias("website"),
                    F.when(fy.between(1800, p.as_of_date.year), fy).alias("founded_year"),
                    "source_system", "loaded_at", "dim_created_at"))


def bronze_fct_clean(raw_fct: DataFrame, p: RunParams = DEFAULT) -> DataFrame:
    """O-PR-12: rank 1..1000 else null; employees, revenue >= 0 else null; date in the 10-year window else as-of."""
    as_of = F.lit(p.as_of_date)
    md = F.col("metric_date")
    return (raw_fct.filter(F.col("company_id").isNotNull() & F.col("company_name").isNotNull()
                           & (F.length(F.trim("company_name")) > 0))
            .select("company_id", "company_name",
                    F.when(F.col("fortune_rank").between(1, 1000), F.col("fortune_rank")).alias("fortune_rank"),
                    F.when(F.col("employee_count") >= 0, F.col("employee_count")).alias("employee_count"),
                    F.when(F.col("revenue_millions") >= 0, F.col("revenue_millions")).alias("revenue_millions"),
                    "revenue_percent_change", "profits_m", "profits_percent_change", "assets_m",
                    "market_cap_updated_m",
                    F.when(md.isNotNull() & (md >= F.add_months(as_of, -120)) & (md <= as_of), md)
                     .otherwise(as_of).alias("metric_date"),
                    "source_system", "loaded_at"))


def mart_project(joined: DataFrame, p: RunParams = DEFAULT) -> DataFrame:
    """O-PR-22: mart column choice and names (sector -> domain, revenue_millions -> revenue)."""
    return joined.select(
        "company_id", "company_name", "ticker", "fortune_rank", F.col("sector").alias("domain"),
        "industry", "industry_primary", "country", "headquarters_city", "headquarters_state",
        "ceo", "founded_year", "website", "employee_count", F.col("revenue_millions").alias("revenue"),
        "market_cap_updated_m", "revenue_percent_change", "profits_m", "profits_percent_change",
        "assets_m", "source_system",
        F.coalesce(F.col("latest_metric_date").cast("timestamp_ntz"), F.col("loaded_at")).alias("last_updated_at"),
        _ts(p).alias("mart_created_at"))


def drop_column_fillna(df: DataFrame, drop: list[str], defaults: dict) -> DataFrame:
    """O-PR-13: drop columns, then per-column defaults for nulls."""
    return df.drop(*drop).fillna(defaults)


def filter_missing(df: DataFrame, fields: list[str], missing: bool = True) -> DataFrame:
    """O-PR-14: rows where any of ``fields`` is null / '' / 'None' (or the complement)."""
    cond = None
    for f in fields:
        c = is_missing_text(f)
        cond = c if cond is None else (cond | c)
    return df.filter(cond if missing else ~cond)
