"""Serving queries of the search API and the dashboard, over the mart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from firmo.functions.numeric import format_currency, format_number
from firmo.functions.text import label_truncate, title_case
from firmo.operators.topk import mart_order, paginate


def search_companies(mart: DataFrame, company_name: str | None = None, industry: str | None = None,
                     country: str | None = None, min_employees: int | None = None,
                     max_employees: int | None = None, min_revenue: float | None = None,
                     max_revenue: float | None = None, founded_year: int | None = None,
                     source_system: str | None = None) -> DataFrame:
    """O-PR-15: conjunction of the given filters.

    The name filter is a case-insensitive literal substring match: ``%`` and
    ``_`` in the input are not wildcards here (they were in the LIKE pattern)."""
    conds: list[Column] = []
    if company_name:
        conds.append(F.upper("company_name").contains(company_name.upper()))
    if industry:
        conds.append(F.col("industry") == industry)
    if country:
        conds.append(F.col("country") == country)
    if min_employees is not None:
        conds.append(F.col("employee_count") >= min_employees)
    if max_employees is not None:
        conds.append(F.col("employee_count") <= max_employees)
    if min_revenue is not None:
        conds.append(F.col("revenue") >= min_revenue)
    if max_revenue is not None:
        conds.append(F.col("revenue") <= max_revenue)
    if founded_year:
        conds.append(F.col("founded_year") == founded_year)
    if source_system:
        conds.append(F.col("source_system") == source_system)
    out = mart
    for c in conds:
        out = out.filter(c)
    return out


def search_page(mart: DataFrame, page: int = 1, page_size: int = 10, **filters) -> tuple[DataFrame, DataFrame]:
    """Search + page, and the total as a one-row frame (two queries, as the API does)."""
    hits = search_companies(mart, **filters)
    total = hits.agg(F.count(F.lit(1)).alias("total"))
    return paginate(hits, page, page_size), total


def search_name_or_ceo(mart: DataFrame, query: str, k: int = 20) -> DataFrame:
    """O-PR-16: name or CEO contains the query (case-insensitive), first k in name order."""
    q = query.strip().lower()
    hit = F.lower("company_name").contains(q) | F.lower("ceo").contains(q)
    return mart.filter(hit).orderBy(*mart_order(mart)).limit(k)


def get_company(mart: DataFrame, company_id: str) -> DataFrame:
    """O-PR-17: point lookup (parquet row-group stats skip non-matching groups)."""
    return mart.filter(F.col("company_id") == company_id)


def display_columns(mart: DataFrame) -> DataFrame:
    """O-PR-18..21: display text of a mart row."""
    return mart.select("company_id", "company_name",
                       title_case("company_name").alias("display_name"),
                       format_currency("revenue").alias("revenue_text"),
                       format_number("employee_count").alias("employees_text"),
                       label_truncate("company_name", 15).alias("label15"))


# The columns of the mart export, in the export's order.
EXPORT_COLUMNS = ["company_id", "company_name", "ticker", "fortune_rank", "domain", "industry",
                  "industry_primary", "country", "headquarters_city", "headquarters_state", "ceo",
                  "website", "founded_year", "employee_count", "revenue", "market_cap_updated_m",
                  "revenue_percent_change", "profits_m", "profits_percent_change", "assets_m",
                  "source_system", "last_updated_at"]


def export_mart_json(mart: DataFrame, path: str) -> None:
    """O-IO-09: the mart's export columns as JSON records in name order."""
    from firmo.sources.sinks import export_json
    export_json(mart.select(*EXPORT_COLUMNS), path, ["company_name", "company_id"])
