"""Dense 1-based row numbering in a global order, without a single-task window.

``row_number() OVER (ORDER BY ...)`` with no partition moves every row into
one task.  Here the frame is range-partitioned and sorted by the order keys
(one shuffle), each partition numbers its rows locally, and a per-partition
count (one row per partition, so bounded by the partition count, never by
the data) gives the offsets that are broadcast back.

The sorted, id-tagged rows are checkpointed (to the shared checkpoint folder)
before they are counted and numbered: both uses then read the same rows, so
the offsets always agree with the local positions even when the input order
(and with it the sampled range bounds) would differ between two evaluations.
The order keys should be total (end with a unique column) for the numbering
of tied rows to be reproducible.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from firmo.session import checkpoint_root


def global_row_number(df: DataFrame, order: list[Column], out: str = "rn") -> DataFrame:
    ordered = (df.orderBy(*order)
                 .withColumn("_pid", F.spark_partition_id())
                 .withColumn("_local", F.monotonically_increasing_id()))
    # monotonically_increasing_id = (partition index << 33) + position in partition
    ordered = ordered.withColumn("_local", F.col("_local") - F.shiftleft(F.col("_pid").cast("long"), 33))
    checkpoint_root(df.sparkSession)
    ordered = ordered.checkpoint(eager=True)
    counts = ordered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    return (ordered.join(F.broadcast(offsets), "_pid")
                   .withColumn(out, F.col("_off") + F.col("_local") + 1)
                   .drop("_pid", "_local", "_off"))


def batch_ids(df: DataFrame, order: list[Column], size: int, out: str = "batch_num") -> DataFrame:
    """Number rows in ``order`` into consecutive batches of ``size`` (0-based)."""
    numbered = global_row_number(df, order, "_rn")
    return numbered.withColumn(out, F.floor((F.col("_rn") - 1) / F.lit(size)).cast("long")).drop("_rn")
