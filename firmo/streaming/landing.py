"""Incremental staging load: new CSV files under a landing folder are typed by
column name and appended to the staging table, each file exactly once.

The reference's staging load is a batch COPY over dated folders.  Here the
file source's checkpoint remembers which files were taken, ``availableNow``
processes what has arrived and stops, and each micro-batch overwrites its own
``batch_id`` partition, so a retried batch does not duplicate rows.  The file
source binds columns by position, so files of one stream share one header
(``header_columns``); a file with another header stops the stream with an error
instead of loading values into the wrong columns, and files of other layouts go
through ``sources.files.scan_csv_by_name``.  Rejected rows are always kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from firmo.sources.files import csv_options, typed_fields


def start_landing(spark: SparkSession, landing_dir: str, table_dir: str, checkpoint_dir: str,
                  schema: T.StructType, header_columns: list[str], reject_dir: str,
                  once: bool = True) -> StreamingQuery:
    text_schema = T.StructType([T.StructField(c, T.StringType()) for c in header_columns])
    raw = (csv_options(spark.readStream.schema(text_schema)).option("header", True).option("enforceSchema", False)
           .option("pathGlobFilter", "*.csv").option("recursiveFileLookup", True)
           .csv(landing_dir)
           .withColumn("source_file", F.col("_metadata.file_path")))
    names = {c.strip().lower(): c for c in header_columns}
    typed, bad = typed_fields(schema, lambda n: F.col(f"`{names[n.lower()]}`") if n.lower() in names else None)
    flagged = raw.select(*typed, bad.alias("_bad"), "source_file")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        good = batch.filter(~F.col("_bad")).drop("_bad", "source_file")
        good.write.mode("overwrite").parquet(f"{table_dir}/batch_id={batch_id}")
        batch.filter(F.col("_bad")).drop("_bad").write.mode("overwrite").parquet(f"{reject_dir}/batch_id={batch_id}")

    w = flagged.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if once else w.trigger(processingTime="30 seconds")
    return w.start()


def read_staging(spark: SparkSession, table_dir: str, schema: T.StructType) -> DataFrame:
    return spark.read.parquet(table_dir).select(*[f.name for f in schema.fields])
