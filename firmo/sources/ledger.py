"""Loads with a kept history (O-IO-04, and skipping or forcing files of O-IO-01).

A table that is loaded from files has two folders: ``rows/load_id=…`` and
``ledger/load_id=…``.  A load reads the files that no earlier load has taken with the
same size and modification time, or all of them where it is forced; writes their rows;
and writes its ledger entries last, one for each file, in a folder of its own.  Rows
count only once their load is in the ledger, so a load that fails changes nothing, and
loads that run at the same time write different folders and lose no entry."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from firmo.sources import files as FI

ENTRY = T.StructType([
    T.StructField("load_time", T.TimestampType()), T.StructField("source_file", T.StringType()),
    T.StructField("file_size", T.LongType()), T.StructField("modified", T.TimestampType()), T.StructField("fingerprint", T.StringType()),
    T.StructField("rows_loaded", T.LongType()), T.StructField("rows_rejected", T.LongType()),
    T.StructField("first_error", T.StringType()), T.StructField("first_error_offset", T.LongType()),
    T.StructField("forced", T.BooleanType()), T.StructField("load_id", T.StringType())])


def _files(spark: SparkSession, root: str, pattern: str | None) -> DataFrame:
    """(source_file, file_size, modified) of the CSV files; contents are not read."""
    if not FI._exists(spark, root):
        return spark.createDataFrame([], "source_file string, file_size long, modified timestamp")
    found = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").load(root)
             .select(F.col("path").alias("source_file"), F.col("length").alias("file_size"), F.col("modificationTime").alias("modified")))
    return found.where(F.col("source_file").rlike(pattern)) if pattern else found


def entries(spark: SparkSession, table: str) -> DataFrame:
    """All ledger entries of a table."""
    at = f"{table.rstrip('/')}/ledger"
    return spark.read.schema(ENTRY).parquet(at).select(*ENTRY.fieldNames()) if FI._exists(spark, at) else spark.createDataFrame([], ENTRY)


def load(spark: SparkSession, root: str, schema: T.StructType, table: str, now: dt.datetime, pattern: str | None = None,
         force: bool = False, range_bytes: int | None = None) -> str | None:
    """Load the CSV files under ``root`` that are new or changed (all, if forced) into
    ``table``; the load's id, or None where there was nothing to load."""
    table, load_id = table.rstrip("/"), uuid.uuid4().hex
    wanted = _files(spark, root, pattern)
    if not force:
        wanted = wanted.join(entries(spark, table), ["source_file", "file_size", "modified"], "left_anti")
    # the files of one load are named to the scan, so their names come to the driver: some
    # 200 bytes each; the folder may change from here on, this list does not
    found = wanted.select("source_file", "file_size", "modified").collect()
    if not found:
        return None
    paths = [r["source_file"] for r in found]
    wanted = spark.createDataFrame(found, "source_file string, file_size long, modified timestamp")
    good, rejects, about = FI.scan_csv(spark, root, schema, None, paths, range_bytes)
    good.drop("byte_offset").write.parquet(f"{table}/rows/load_id={load_id}")
    loaded = good.groupBy("source_file").agg(F.count(F.lit(1)).alias("rows_loaded"))
    bad = rejects.groupBy("source_file").agg(F.count(F.lit(1)).alias("rows_rejected"), F.min("byte_offset").alias("first_error_offset"),
                                             F.min_by("cause", "byte_offset").alias("first_error"))
    rows = (wanted.join(loaded, "source_file", "left").join(bad, "source_file", "left").join(about, "source_file", "left")
            .withColumn("load_time", F.lit(now)).withColumn("forced", F.lit(force))
            .withColumn("fingerprint", F.sha2(F.concat_ws(":", "n_bytes", "print"), 256)))
    rows = rows.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("rows_loaded", "rows_rejected")})
    rows.select(*ENTRY.fieldNames()[:-1]).coalesce(1).write.parquet(f"{table}/ledger/load_id={load_id}")
    return load_id


def read(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    """The rows of the latest load of each file, and of loads in the ledger only."""
    at = f"{table.rstrip('/')}/rows"
    if not FI._exists(spark, at):
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("source_file", T.StringType())]))
    last = entries(spark, table).groupBy("source_file").agg(F.max_by("load_id", F.struct("load_time", "load_id")).alias("load_id"))
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField("source_file", T.StringType()), T.StructField("load_id", T.StringType())])).parquet(at)
    # one row per file of the table
    return rows.join(last, ["source_file", "load_id"], "left_semi").select(*schema.fieldNames(), "source_file")


def load_history(spark: SparkSession, table: str, as_of: dt.datetime, hours: int = 24, last: int = 5) -> DataFrame:
    """The ``last`` newest entries of the ``hours`` up to ``as_of``, by load time (ties by file)."""
    since = as_of - dt.timedelta(hours=hours)
    recent = entries(spark, table).where((F.col("load_time") >= F.lit(since)) & (F.col("load_time") <= F.lit(as_of)))
    return recent.orderBy(F.col("load_time").desc(), "source_file", "load_id").limit(last)
