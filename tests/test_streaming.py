import os

from pyspark.sql import types as T

from firmo.streaming.landing import read_staging, start_landing

SCHEMA = T.StructType([T.StructField("name", T.StringType()), T.StructField("n", T.IntegerType())])


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_incremental_landing_takes_each_file_once(spark, tmpdir_path):
    land, table, ckpt, rej = (f"{tmpdir_path}/{x}" for x in ("landing", "table", "_ckpt", "rejects"))
    write(f"{land}/2024-01-01/a.csv", "name,n\na,1\nb,zz\n")
    start_landing(spark, land, table, ckpt, SCHEMA, ["name", "n"], rej).awaitTermination()
    assert sorted((r.name, r.n) for r in read_staging(spark, table, SCHEMA).collect()) == [("a", 1)]
    assert [r.name for r in spark.read.parquet(rej).collect()] == ["b"]
    write(f"{land}/2024-01-02/b.csv", "name,n\nc,3\n")
    start_landing(spark, land, table, ckpt, SCHEMA, ["name", "n"], rej).awaitTermination()
    assert sorted((r.name, r.n) for r in read_staging(spark, table, SCHEMA).collect()) == [("a", 1), ("c", 3)]


def test_another_header_is_not_bound_by_position(spark, tmpdir_path):
    import pytest
    land, table, ckpt, rej = (f"{tmpdir_path}/{x}" for x in ("landing", "table", "_ckpt", "rejects"))
    write(f"{land}/2024-01-01/a.csv", "n,name\n1,a\n")
    with pytest.raises(Exception, match="(?i)header"):
        start_landing(spark, land, table, ckpt, SCHEMA, ["name", "n"], rej).awaitTermination()
