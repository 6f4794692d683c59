"""Sort, limit and top-k (O-TK-*).  ``orderBy(...).limit(k)`` plans as
TakeOrderedAndProject: each task keeps its own k best rows, so only k rows per
task move, never the whole input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from firmo.functions.text import label_truncate

MART_ORDER_COLS = ["company_name", "company_id", "fortune_rank", "revenue", "employee_count",
                   "profits_m", "assets_m", "market_cap_updated_m", "revenue_percent_change",
                   "profits_percent_change", "last_updated_at", "founded_year", "country", "website"]


def mart_order(df: DataFrame) -> list[Column]:
    """Name order with a total tie-break over the remaining mart columns."""
    return [F.col(c).asc_nulls_last() for c in MART_ORDER_COLS if c in df.columns]


def paginate(df: DataFrame, page: int = 1, page_size: int = 10, order: list[Column] | None = None) -> DataFrame:
    """O-TK-01: page ``page`` (1-based) of ``page_size`` (1..100) rows in ``order``."""
    if page < 1 or not 1 <= page_size <= 100:
        raise ValueError("page >= 1 and 1 <= page_size <= 100")
    order = order if order is not None else mart_order(df)
    return df.orderBy(*order).offset((page - 1) * page_size).limit(page_size)


def page_after(df: DataFrame, after: dict, page_size: int = 10, keys: list[str] | None = None) -> DataFrame:
    """The page that follows the row with the key values ``after`` (a prefix of the
    order): each task keeps one page, however deep the page lies."""
    if not 1 <= page_size <= 100:
        raise ValueError("1 <= page_size <= 100")
    names = list(after)
    later, same = F.lit(False), F.lit(True)
    for c in names:
        later = later | (same & (F.col(c) > F.lit(after[c])))
        same = same & (F.col(c) == F.lit(after[c]))
    order = [F.col(c).asc_nulls_last() for c in keys] if keys else mart_order(df)
    return df.filter(later).orderBy(*order).limit(page_size)


def top_k(df: DataFrame, by: str, k: int, where: Column | None = None,
          tiebreak: list[Column] | None = None) -> DataFrame:
    base = df if where is None else df.filter(where)
    return base.orderBy(F.col(by).desc_nulls_last(), *(tiebreak or mart_order(df))).limit(k)


def top_market_cap6(mart: DataFrame) -> DataFrame:
    """O-TK-02: six largest positive market caps."""
    return (top_k(mart, "market_cap_updated_m", 6, F.col("market_cap_updated_m") > 0)
            .select("company_name", "ticker", "market_cap_updated_m", "fortune_rank", "domain",
                    "revenue", "employee_count", "founded_year"))


def top_revenue15(mart: DataFrame) -> DataFrame:
    """O-TK-03: fifteen largest revenues, in billions, with a 20-char label."""
    return (top_k(mart, "revenue", 15, F.col("revenue") > 0)
            .select(label_truncate("company_name", 20).alias("label"),
                    (F.col("revenue") / F.lit(1e9)).alias("revenue_billions")))


def top_revenue_change15(mart: DataFrame) -> DataFrame:
    """O-TK-04: fifteen largest revenue % changes (nulls dropped), 18-char label."""
    return (top_k(mart, "revenue_percent_change", 15, F.col("revenue_percent_change").isNotNull())
            .select(label_truncate("company_name", 18).alias("label"), "revenue_percent_change"))


def growth_and_decline(mart: DataFrame) -> DataFrame:
    """O-TK-05: growth ranks 2..11 (the largest is left out) and the 10 steepest
    declines, by absolute change, at most 20."""
    chg = F.col("revenue_percent_change")
    tb = mart_order(mart)
    growth = mart.filter(chg > 0).orderBy(chg.desc(), *tb).offset(1).limit(10)
    decline = mart.filter(chg < 0).orderBy(chg.asc(), *tb).limit(10)
    both = growth.unionByName(decline)
    return (both.orderBy(F.abs(chg).desc(), *tb).limit(20)
            .select(label_truncate("company_name", 18).alias("label"), "revenue_percent_change",
                    F.when(chg > 0, F.lit("growth")).otherwise(F.lit("decline")).alias("direction")))


def nlargest(df: DataFrame, by: str, k: int, cols: list[str], where: Column | None = None,
             first_order: str = "rank") -> DataFrame:
    """O-TK-06: pandas ``nlargest`` (keep='first': ties in input order)."""
    base = df if where is None else df.filter(where)
    return base.orderBy(F.col(by).desc_nulls_last(), F.col(first_order).asc_nulls_last()).limit(k).select(*cols)


def sample_n(df: DataFrame, n: int, seed: int, key: Column) -> DataFrame:
    """O-TK-08: exactly ``n`` pseudo-random rows, reproducible across partitionings.

    Rows are ordered by md5(seed | key); the order does not depend on how the
    data is split, which ``sample()`` cannot promise."""
    h = F.md5(F.concat(F.lit(f"{seed}|"), key.cast("string")))
    return df.orderBy(h, key).limit(n)
