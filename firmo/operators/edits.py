"""Replayable edits of a tabular dataset (O-AN-*).

An edit log (seq, op, row_id, column, value) with ops ``set``, ``add`` and
``delete`` is applied as set operations: the last ``set`` per (row, column)
wins (a partial aggregate), ``add`` contributes a new row of empty strings,
``delete`` removes the row (anti join).  Undo/redo to step n is the same
replay over ``seq <= n``; no history cap is needed.  Rows are addressed by a
stable ``row_id``, not by a position that shifts after deletes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def apply_edits(base: DataFrame, edits: DataFrame, columns: list[str], key: str = "row_id") -> DataFrame:
    """O-AN-01: the dataset after all edits.

    The log is read once and reduced to one row per ``row_id`` (partial
    aggregation map-side): the last value set per column, whether the row was
    added, whether it was deleted.  One full outer join with the base then
    yields every surviving row."""
    is_set = F.col("op") == "set"
    per_row = edits.groupBy(key).agg(
        *[F.max_by("value", F.when(is_set & (F.col("column") == c), F.col("seq"))).alias(f"_v_{c}") for c in columns],
        *[F.max(is_set & (F.col("column") == c)).alias(f"_s_{c}") for c in columns],
        F.max(F.col("op") == "add").alias("_added"),
        F.max(F.col("op") == "delete").alias("_deleted"))
    b = base.select(key, *[F.col(c).cast("string").alias(c) for c in columns]).withColumn("_base", F.lit(True))
    j = b.join(per_row, key, "full")
    keep = (F.col("_base") | F.coalesce(F.col("_added"), F.lit(False))) & ~F.coalesce(F.col("_deleted"), F.lit(False))
    cur = lambda c: F.when(F.col("_base"), F.col(c)).otherwise(F.lit(""))
    return j.filter(keep).select(
        key, *[F.when(F.coalesce(F.col(f"_s_{c}"), F.lit(False)), F.col(f"_v_{c}")).otherwise(cur(c)).alias(c)
               for c in columns])


def edits_as_of(base: DataFrame, edits: DataFrame, columns: list[str], seq: int, key: str = "row_id") -> DataFrame:
    """O-AN-02: the dataset after edit ``seq`` (undo/redo)."""
    return apply_edits(base, edits.filter(F.col("seq") <= seq), columns, key)


def rows_page(df: DataFrame, page: int, size: int = 10, key: str = "row_id") -> DataFrame:
    """O-AN-03: page of ``size`` rows in row order."""
    return df.orderBy(key).offset((page - 1) * size).limit(size)


def rows_after(df: DataFrame, last_id: int, size: int = 10, key: str = "row_id") -> DataFrame:
    """O-AN-03 by key: the ``size`` rows after row ``last_id``; each task keeps one page."""
    return df.filter(F.col(key) > last_id).orderBy(key).limit(size)
