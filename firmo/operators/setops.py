"""Set operations and distinct (O-SO-*)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def union_sources(*frames: DataFrame) -> DataFrame:
    """O-SO-01 / O-SO-02: UNION ALL by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def recombine(*frames: DataFrame) -> DataFrame:
    """O-SO-05: concatenate frames, filling absent columns with null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """O-SO-03 / O-SO-04: sorted distinct non-null values."""
    return df.filter(F.col(col).isNotNull()).select(col).distinct().orderBy(col)


def union_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """O-SO-06: one (table_name, row_count) row per table."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)
