"""Loads with a kept history."""
import datetime as dt
import os
import time

from pyspark.sql import functions as F
from pyspark.sql import types as T

from firmo.sources import ledger as LG

SCHEMA = T.StructType([T.StructField("a", T.StringType()), T.StructField("n", T.IntegerType())])
NOW = dt.datetime(2024, 5, 1, 12)


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def rows(spark, table):
    return sorted((r.a, r.n) for r in LG.read(spark, table, SCHEMA).collect())


def test_second_load_takes_new_and_changed_files_only(spark, tmpdir_path):
    root, table = f"{tmpdir_path}/in", f"{tmpdir_path}/table"
    assert LG.load(spark, root, SCHEMA, table, NOW) is None and rows(spark, table) == []
    put(f"{root}/1.csv", "a,n\nx,1\ny,zz\n")
    put(f"{root}/2.csv", "n,a\n2,\"z\n\"\n")
    assert LG.load(spark, root, SCHEMA, table, NOW - dt.timedelta(hours=30))
    assert LG.load(spark, root, SCHEMA, table, NOW) is None
    time.sleep(1.1)
    put(f"{root}/2.csv", "n,a\n3,zz\n")
    put(f"{root}/3.csv", "a,n\nnew,\"4")
    assert LG.load(spark, root, SCHEMA, table, NOW - dt.timedelta(hours=2))
    assert rows(spark, table) == [("x", 1), ("zz", 3)]
    got = [(os.path.basename(r.source_file), r.rows_loaded, r.rows_rejected, r.first_error_offset, r.forced) for r in LG.load_history(spark, table, NOW).collect()]
    assert got == [("2.csv", 1, 0, None, False), ("3.csv", 0, 1, 4, False)]
    assert LG.load(spark, root, SCHEMA, table, NOW - dt.timedelta(hours=1), r"/1\.csv$", force=True)
    assert rows(spark, table) == [("x", 1), ("zz", 3)]
    first = LG.load_history(spark, table, NOW).first()
    assert (first.forced, first.rows_rejected, first.first_error_offset) == (True, 1, 8) and len(first.fingerprint) == 64
    assert LG.entries(spark, table).count() == 5


def test_rows_of_a_load_that_failed_do_not_count(spark, tmpdir_path):
    root, table = f"{tmpdir_path}/in", f"{tmpdir_path}/table"
    put(f"{root}/1.csv", "a,n\nx,1\n")
    LG.load(spark, root, SCHEMA, table, NOW)
    good = spark.read.parquet(f"{table}/rows").drop("load_id")
    good.withColumn("a", F.lit("lost")).write.parquet(f"{table}/rows/load_id=dead")     # no entry follows
    assert rows(spark, table) == [("x", 1)]
