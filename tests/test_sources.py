import datetime as dt
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from firmo.sources import files as FI
from firmo.sources import sinks as SK

SCHEMA = T.StructType([T.StructField("name", T.StringType()), T.StructField("n", T.IntegerType()),
                       T.StructField("city", T.StringType()), T.StructField("score", T.DoubleType())])


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_scan_by_name_nulls_short_long_and_bad_rows(spark, tmpdir_path):
    write(f"{tmpdir_path}/2024-01-01/a.csv",
          'CITY,Name, N \n'
          '"Paris, FR",acme,1\n'
          'NULL,beta,\\N\n'
          'null,"",3\n'
          'Rome,gamma\n'
          'Oslo,delta,4,extra\n'
          'Lima,eps,zz\n')
    write(f"{tmpdir_path}/2024-01-02/b.csv", 'name,n,score\nzeta,7,1.5\n')
    write(f"{tmpdir_path}/other/c.csv", 'name,n\nignored,1\n')
    good, bad = FI.scan_csv_by_name(spark, tmpdir_path, SCHEMA, r".*/\d{4}-\d{2}-\d{2}/[^/]*\.csv$")
    rows = {r.name: r for r in good.collect()}
    assert set(rows) == {"acme", "beta", "", "gamma", "delta", "zeta"}
    assert rows["acme"].city == "Paris, FR" and rows["acme"].n == 1
    assert rows["beta"].city is None and rows["beta"].n is None
    assert rows[""].city is None and rows[""].n == 3            # quoted "" stays an empty string
    assert rows["gamma"].n is None                                # short row accepted
    assert rows["delta"].n == 4                                   # extra field dropped
    assert rows["zeta"].score == 1.5 and rows["zeta"].city is None
    assert [r.name for r in bad.collect()] == ["eps"]             # 'zz' in an int column
    good2, bad2 = FI.scan_csv_by_name(spark, tmpdir_path, SCHEMA, r".*/\d{4}-\d{2}-\d{2}/[^/]*\.csv$", with_file=True)
    audit = FI.load_audit(good2, bad2, F.regexp_extract("source_file", r"/(\d{4}-\d{2}-\d{2})/", 1)).collect()
    assert [(r.load_unit, r.rows_loaded, r.rows_rejected) for r in audit] == [("2024-01-02", 1, 0), ("2024-01-01", 5, 1)]


def test_quoted_line_ends_and_open_quotes(spark, tmpdir_path):
    write(f"{tmpdir_path}/a.csv", 'name,n,city\n"Two\nlines",1990,Bonn\nacme,7,"Rome, ""IT"""\n')
    write(f"{tmpdir_path}/b.csv", '"city","name"\nUK,Bolt\n')
    write(f"{tmpdir_path}/c.csv", 'name,city\nlast,"Oslo\nnext,Bonn\n')
    good, bad = FI.scan_csv_by_name(spark, tmpdir_path, SCHEMA)
    rows = {r.name: (r.n, r.city) for r in good.collect()}
    assert rows == {"Two\nlines": (1990, "Bonn"), "acme": (7, 'Rome, "IT"'), "Bolt": (None, "UK")}
    assert [r.name for r in bad.collect()] == ["last"]
    assert FI.scan_csv_by_name(spark, f"{tmpdir_path}/none", SCHEMA)[0].count() == 0


def test_land_partitioned_rerun_is_idempotent(spark, tmpdir_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "name string, n int")
    for _ in range(2):
        SK.land_partitioned(df, tmpdir_path, "src", dt.date(2024, 1, 1))
    SK.land_partitioned(df.limit(1), tmpdir_path, "src", dt.date(2024, 1, 2))
    assert SK.read_landed(spark, tmpdir_path, "src", "2024-01-01").count() == 2
    assert SK.read_landed(spark, tmpdir_path, "src").count() == 3


def test_first_available_and_multi_file(spark, tmpdir_path):
    spark.createDataFrame([("a", 1)], "name string, n int").write.parquet(f"{tmpdir_path}/third/p1")
    spark.createDataFrame([("b", 2.0)], "name string, x double").write.parquet(f"{tmpdir_path}/third/p2")
    os.makedirs(f"{tmpdir_path}/second")
    df = FI.scan_first_available(spark, [f"{tmpdir_path}/first", f"{tmpdir_path}/second", f"{tmpdir_path}/third"])
    assert sorted(df.columns) == ["n", "name", "x"] and df.count() == 2


def test_export_json_and_csv_round_trip(spark, tmpdir_path):
    df = spark.createDataFrame([("b", dt.datetime(2024, 1, 2, 3, 4, 5)), ("a", None)], "company_name string, ts timestamp_ntz")
    SK.export_json(df, f"{tmpdir_path}/j", ["company_name"])
    back = spark.read.json(f"{tmpdir_path}/j").orderBy("company_name").collect()
    assert [(r.company_name, r.ts) for r in back] == [("a", None), ("b", "2024-01-02T03:04:05")]
    SK.export_csv(df, f"{tmpdir_path}/c")
    text = "".join(open(os.path.join(f"{tmpdir_path}/c", f)).read() for f in sorted(os.listdir(f"{tmpdir_path}/c"))
                   if f.endswith(".csv"))
    assert '"company_name","ts"' in text and '"b","2024-01-02T03:04:05"' in text


def test_preview_sample(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    assert [r.k for r in FI.preview_sample(df, 5, [F.col("k").desc()]).collect()] == [99, 98, 97, 96, 95]
