"""Serving aggregates over the mart (O-AG-02..08).  Every statistic of one
screen is folded into one ``agg`` (one scan, partial aggregation map-side)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def count_by(df: DataFrame, col: str, k: int | None = 20, out: str = "count") -> DataFrame:
    """O-AG-02/03/07: non-null values, their counts, top k by count (ties by value, Q15)."""
    g = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias(out))
    g = g.orderBy(F.col(out).desc(), F.col(col).asc())
    return g.limit(k) if k else g


def global_statistics(mart: DataFrame) -> DataFrame:
    """O-AG-04: total rows; averages and min/max founded year over rows with any of them.

    Each aggregate skips nulls, so the model's OR-filter changes nothing and
    everything folds into one pass."""
    return mart.agg(F.count(F.lit(1)).alias("total_companies"),
                    F.round(F.avg("employee_count"), 4).alias("average_employee_count"),
                    F.round(F.avg("revenue"), 2).alias("average_revenue"),
                    F.min("founded_year").alias("oldest_company_year"),
                    F.max("founded_year").alias("newest_company_year"))


def _truthy(c: str):
    return F.col(c).isNotNull() & (F.col(c) != 0)


def _country_key():
    c = F.trim(F.col("country"))
    return F.when(F.col("country").isNotNull() & (c != "") & (F.upper(c) != "UNKNOWN"), c)


def _industry_key():
    raw = F.coalesce(F.nullif(F.col("industry"), F.lit("")), F.col("industry_primary"))
    c = F.trim(raw)
    return F.when(raw.isNotNull() & (c != "") & (F.upper(c) != "UNKNOWN"), c)


def export_statistics(mart: DataFrame) -> DataFrame:
    """O-AG-05 scalars: totals, distinct countries/industries (blank and UNKNOWN
    excluded; industry falls back to the primary industry), rows with a
    rank/year/revenue, mean of positive employee counts (0 when none)."""
    return mart.agg(
        F.count(F.lit(1)).alias("total_companies"),
        F.count_distinct(_country_key()).alias("total_countries"),
        F.count_distinct(_industry_key()).alias("total_industries"),
        F.count_if(_truthy("fortune_rank")).alias("companies_with_fortune_rank"),
        F.count_if(_truthy("founded_year")).alias("companies_with_founded_year"),
        F.count_if(_truthy("revenue")).alias("companies_with_revenue"),
        F.round(F.coalesce(F.avg(F.when(F.col("employee_count") > 0, F.col("employee_count"))), F.lit(0.0)), 4)
         .alias("avg_employee_count"))


def country_distribution(mart: DataFrame) -> DataFrame:
    """O-AG-05 distribution: (country, count), by count desc."""
    return count_by(mart.select(_country_key().alias("country")), "country", None)


def industry_distribution(mart: DataFrame) -> DataFrame:
    return count_by(mart.select(_industry_key().alias("industry")), "industry", None)


def _as_json(dist: DataFrame, name: str) -> DataFrame:
    """A (value, count) distribution as one JSON object, by count desc, then value."""
    rows = F.array_sort(F.collect_list(F.struct((-F.col("count")).alias("n"), F.col(name).alias("k"))))
    return dist.agg(F.to_json(F.map_from_entries(F.transform(rows, lambda x: F.struct(x["k"], -x["n"])))).alias(name))


def statistics_record(mart: DataFrame) -> DataFrame:
    """O-AG-05: the one statistics record: scalars and both sorted distributions."""
    countries = _as_json(country_distribution(mart), "country").withColumnRenamed("country", "countries")
    industries = _as_json(industry_distribution(mart), "industry").withColumnRenamed("industry", "industries")
    # three one-row frames side by side
    return export_statistics(mart).withColumn("_one", F.lit(1)).join(countries.withColumn("_one", F.lit(1)), "_one").join(industries.withColumn("_one", F.lit(1)), "_one").drop("_one")


def top_industries10(mart: DataFrame) -> DataFrame:
    """O-TK-07: first ten of the sorted industry distribution."""
    return industry_distribution(mart).limit(10)


def total_revenue(mart: DataFrame) -> DataFrame:
    """O-AG-06: sum of revenue with null as 0 (exact decimal sum, then double)."""
    return mart.agg(F.sum(F.coalesce(F.col("revenue"), F.lit(0)).cast("decimal(38,4)"))
                    .cast("double").alias("total_revenue"))


# The employee-count buckets of the dashboard (lower bound inclusive).
EMPLOYEE_BUCKETS = [("0-10K", 0, 10000), ("10K-50K", 10000, 50000), ("50K-100K", 50000, 100000),
                    ("100K-200K", 100000, 200000), ("200K+", 200000, None)]


def employee_buckets(spark: SparkSession, mart: DataFrame, null_bucket: bool = False) -> DataFrame:
    """O-AG-08: counts per bucket, empty buckets shown as 0.

    The model's script counts null in the first bucket (``null >= 0`` is true
    there); ``null_bucket=True`` reproduces that, the default leaves nulls out."""
    e = F.col("employee_count")
    label = None
    for name, lo, hi in EMPLOYEE_BUCKETS:
        cond = (e >= lo) if hi is None else ((e >= lo) & (e < hi))
        label = F.when(cond, F.lit(name)) if label is None else label.when(cond, F.lit(name))
    if null_bucket:
        label = label.when(e.isNull(), F.lit(EMPLOYEE_BUCKETS[0][0]))
    counts = mart.select(label.alias("bucket")).filter(F.col("bucket").isNotNull()) \
                 .groupBy("bucket").agg(F.count(F.lit(1)).alias("count"))
    frame = spark.createDataFrame([(i, n) for i, (n, _, _) in enumerate(EMPLOYEE_BUCKETS)],
                                  "bucket_order int, bucket string")
    # five fixed buckets: a bounded broadcast
    return (F.broadcast(frame).join(counts, "bucket", "left")
            .select("bucket_order", "bucket", F.coalesce("count", F.lit(0)).cast("long").alias("count"))
            .orderBy("bucket_order"))
