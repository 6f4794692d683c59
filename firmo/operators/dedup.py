"""Keep one row per key by a preference order (``row_number() = 1``).

Catalyst's InferWindowGroupLimit turns the filter into a partial
``WindowGroupLimit`` before the shuffle, so a hot key is cut to one row per
map task before it moves: the shuffle stays bounded under skew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def asc(c: str) -> Column:
    return F.col(c).asc_nulls_last()


def desc(c: str) -> Column:
    return F.col(c).desc_nulls_last()


def flag(cond: Column) -> Column:
    """0 when ``cond`` holds, else 1 (null counts as not holding)."""
    return F.when(cond, F.lit(0)).otherwise(F.lit(1))


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


# --- orders of the three dedup models ------------------------------------------------
# The reference's criteria come first; the tie-break after them is ours (it
# leaves ties open).  Primary-side and secondary-side criteria are separable,
# which lets the dimension pre-reduce each source before the join.

def primary_order() -> list[Column]:
    """Best primary row per (name, country): ticker known, sector known, then its own columns.

    Applied after ticker/sector/industry defaults (UNKNOWN), as in the model."""
    return [flag(F.col("ticker").isNotNull() & (F.col("ticker") != "UNKNOWN")),
            flag(F.col("sector").isNotNull() & (F.col("sector") != "UNKNOWN")),
            asc("ticker"), asc("sector"), asc("industry"), asc("headquarters_city"),
            asc("headquarters_state"), asc("ceo"), asc("website")]


def source_class() -> Column:
    kaggle = F.col("source_system").like("kaggle:%")
    return (F.when(kaggle & F.col("founded_year").isNotNull(), F.lit(0))
             .when(kaggle, F.lit(1)).otherwise(F.lit(2)))


def secondary_match_order() -> list[Column]:
    """Secondary row that enriches a primary row: founded year present, newest, then its columns."""
    return [flag(F.col("founded_year").isNotNull()), desc("loaded_at"), asc("website"),
            asc("founded_year"), asc("industry"), asc("source_system")]


def secondary_alone_order() -> list[Column]:
    """Secondary row kept for a key with no primary row (the model's order on such rows)."""
    return [flag(F.col("founded_year").isNotNull()), source_class(), desc("loaded_at"),
            asc("website"), asc("founded_year"), asc("industry"), asc("source_system")]


def fct_order() -> list[Column]:
    """Metrics per (company_id, metric_date): primary source, revenue > 0, employees > 0, newest."""
    return [flag(F.col("source_system") == "fortune1000"),
            flag(F.col("revenue_millions") > 0), flag(F.col("employee_count") > 0),
            desc("loaded_at"),
            asc("fortune_rank"), asc("employee_count"), asc("revenue_millions"),
            asc("revenue_percent_change"), asc("profits_m"), asc("profits_percent_change"),
            asc("assets_m"), asc("market_cap_march_m"), asc("market_cap_updated_m")]


def founder_order() -> list[Column]:
    return [flag(F.col("founder_name").isNotNull()), asc("company_name"), asc("founder_name")]


def as_struct(order: list) -> Column:
    """An order as one comparable value, for ``min_by``: (column, ascending) with
    nulls last, or a flag.  Times descend by their negated microseconds."""
    parts = []
    for o in order:
        if isinstance(o, tuple):
            c = F.col(o[0])
            parts += [c.isNull(), c if o[1] else -F.unix_micros(c.cast("timestamp"))]
        else:
            parts.append(o)
    return F.struct(*[p.alias(f"o{i}") for i, p in enumerate(parts)])


def primary_rank() -> Column:
    return as_struct([*primary_order()[:2], *[(c, True) for c in ("ticker", "sector", "industry", "headquarters_city",
                                                                  "headquarters_state", "ceo", "website")]])


_SECONDARY_TAIL = [("loaded_at", False), ("website", True), ("founded_year", True), ("industry", True), ("source_system", True)]


def secondary_match_rank() -> Column:
    return as_struct([flag(F.col("founded_year").isNotNull()), *_SECONDARY_TAIL])


def secondary_alone_rank() -> Column:
    return as_struct([flag(F.col("founded_year").isNotNull()), source_class(), *_SECONDARY_TAIL])


def dedup_primary(df: DataFrame) -> DataFrame:
    return keep_first(df, ["company_name", "country"], primary_order())


def dedup_secondary_match(df: DataFrame) -> DataFrame:
    return keep_first(df, ["company_name", "country"], secondary_match_order())


def dedup_secondary_alone(df: DataFrame) -> DataFrame:
    return keep_first(df, ["company_name", "country"], secondary_alone_order())


def dedup_fct(df: DataFrame) -> DataFrame:
    """O-WN-02."""
    return keep_first(df, ["company_id", "metric_date"], fct_order())


def dedup_founder(df: DataFrame) -> DataFrame:
    """O-WN-03: one row per id, rows with a founder first."""
    return keep_first(df, ["id"], founder_order())
