"""Adapter: the given TPC-H-like tables -> the two staging shapes.

``stg_primary`` has one row per customer (a ranked company list, 32 staging
columns); ``stg_secondary`` has one row per customer and supplier: re-spelled
primary companies, companies of its own, and suppliers.  FIXTURES.md lists the
planted cases: duplicates on every key the layers reduce, a hot name, blank and
aliased values, unparsable times.  Both frames are lazy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from firmo.operators.numbering import global_row_number
from firmo.schemas import STG_PRIMARY, STG_SECONDARY
from firmo.sources.tables import table

# Spellings of countries that ingestion folds, and one that it leaves.
COUNTRY_SPELLINGS = ["US", "united states", " United States of America ", "UK", "United Kingdom", "U.S."]


def _s(x) -> Column:
    return x.cast("string")


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index % len(values) + 1).cast("int"))


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with their group of six (``g``), place in it (``m``) and country.
    The last two of a group share their country, so that they agree on every key.
    The narrow rows are dealt by key: a table of one row group is read by one task,
    and the wide rows made of it would all be made and written by that task."""
    cust = (table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
            .repartition("c_custkey"))
    # nation is a fixed 25-row dimension: broadcasting it is bounded by construction
    nation = F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    c = cust.select("*", F.expr("c_custkey div 6").alias("g"), (F.col("c_custkey") % 6).alias("m"))
    home = F.when(F.col("m") >= 4, F.col("g") % 25).otherwise(F.col("c_nationkey"))
    return c.join(nation, home == F.col("n_nationkey")).drop("n_nationkey")


def stg_primary(spark: SparkSession, sf_dir: str) -> DataFrame:
    # partial (map-side) aggregation of orders per customer before the join
    per_cust = (table(spark, sf_dir, "orders")
                .groupBy("o_custkey")
                .agg(F.sum("o_totalprice").alias("rev"),
                     F.count(F.lit(1)).alias("n_orders"),
                     F.max("o_orderdate").alias("last_order")))
    t = (_customers(spark, sf_dir).join(per_cust, F.col("c_custkey") == F.col("o_custkey"), "left")
         .withColumn("rev2", F.round("rev", 2)))
    # number the narrow keys only; the wide row joins them afterwards
    ranks = global_row_number(t.select("c_custkey", "rev2"), [F.col("rev2").desc_nulls_last(), F.col("c_custkey").asc()], "_rank")
    t = t.join(ranks.select("c_custkey", "_rank"), "c_custkey")
    k, g, m = F.col("c_custkey"), F.col("g"), F.col("m")
    yes = lambda cond, a="yes", b="no": F.when(cond, F.lit(a)).otherwise(F.lit(b))
    none_at = lambda n, x: F.when(k % n == 0, F.lit(None)).otherwise(x)
    moved = none_at(8, (k % 41 - 20).cast("double"))
    cols = {
        "rank": F.col("_rank"),
        "company": F.when(k % 62 == 0, F.lit(None)).when(k % 31 == 0, F.lit("   ")).when(k % 50 == 7, F.lit(" Company Hub "))
                    .otherwise(F.concat(F.lit(" Company "), _s(g), F.lit(" "))),
        "ticker": F.when(k % 5 == 0, F.lit("")).otherwise(F.concat(F.lit("tk"), _s(F.expr("c_custkey div 2")))),
        "sector": F.when(k % 11 == 0, F.lit("  ")).otherwise(F.concat("c_mktsegment", F.lit(" "), _s(g % 3))),
        "industry": none_at(7, F.concat(F.col("c_mktsegment"), F.lit(" services"), F.when(k % 4 == 0, F.concat(F.lit(" "), _s(g % 5))).otherwise(F.lit("")))),
        "profitable": yes(k % 2 == 0),
        "founder_is_ceo": yes(F.expr("c_custkey div 2") % 3 != 1, " Yes "),
        "femaleceo": yes(k % 9 == 0),
        "growth_in_jobs": none_at(10, yes(k % 4 < 2)),
        "change_in_rank": moved,
        "gained_in_rank": yes(moved > 0),
        "dropped_in_rank": yes(moved < 0),
        "newcomer_to_the_fortune500": yes(k % 40 == 1),
        "global500": yes(k % 6 == 1, "YES"),
        "worlds_most_admired_companies": yes(k % 12 == 3),
        "best_companies_to_work_for": yes(k % 15 == 4),
        "number_of_employees": F.when(k % 13 == 0, F.lit(-1)).when(k % 14 == 0, F.lit(None)).otherwise((k % 1000) * 321),
        "marketcap_march28_m": F.when(k % 4 == 1, F.lit(None)).otherwise(F.col("c_acctbal") * 9),
        "revenues_m": F.col("rev2") / F.lit(1000000),
        "revenuepercentchange": none_at(17, (k % 400 - 200).cast("double") / 4),
        "profits_m": F.col("c_acctbal"),
        "profitspercentchange": none_at(16, (k % 304 - 152).cast("double") / 8),
        "assets_m": F.col("n_orders") * 1.5,
        "ceo": none_at(6, F.concat(F.lit("Ceo "), _s(k))),
        "country": F.when(k % 29 == 0, F.lit("")).when(k % 37 == 0, _pick(COUNTRY_SPELLINGS, F.expr("c_custkey div 37"))).otherwise(F.col("n_name")),
        "headquarterscity": F.concat(F.lit("City "), _s(k % 40)),
        "headquartersstate": none_at(3, F.concat(F.lit("State "), _s(k % 12))),
        "website": F.when(k % 9 == 0, F.lit("")).otherwise(F.concat(F.lit("HTTPS://www.Co"), _s(k), F.lit(".com:8080/x"))),
        "companytype": none_at(18, yes(k % 5 < 3, "Public", "Private")),
        "footnote": F.when(k % 20 == 3, F.concat(F.lit("see note "), _s(k % 7))),
        "marketcap_updated_m": F.when(k % 4 == 0, F.lit(None)).otherwise(F.col("c_acctbal") * 10),
        "updated": F.when(m >= 4, F.when(g % 2 == 0, F.lit("2000-02-29")).cast("date"))
                    .when(k % 19 == 0, F.lit("1990-01-01").cast("date")).otherwise(F.col("last_order").cast("date")),
    }
    return t.select(*[cols[f.name].cast(f.dataType).alias(f.name) for f in STG_PRIMARY.fields])


def stg_secondary(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, g, m = F.col("c_custkey"), F.col("g"), F.col("m")
    own = m.isin(1, 2)                  # companies that the primary list does not have
    cust = _customers(spark, sf_dir).select(
        F.when(own, F.concat(F.lit("Indie "), _s(g), F.lit(" "))).when(k % 50 == 7, F.lit("company hub"))
         .otherwise(F.concat(F.lit("company "), _s(g))).alias("company_name"),
        F.when(k % 12 == 5, F.lit(None)).otherwise(F.concat(F.lit("http://www.Co"), _s(k), F.lit(".net/about"))).alias("domain"),
        F.when(k % 21 == 0, F.lit("")).otherwise(F.col("c_mktsegment")).alias("industry"),
        F.when(own, F.concat(F.lit("Land "), _s(g % 7))).when(k % 37 == 0, F.lower(_pick(COUNTRY_SPELLINGS, F.expr("c_custkey div 37"))))
         .otherwise(F.lower("n_name")).alias("country"),
        F.when(k % 4 == 0, F.lit(None)).otherwise(k % 5000).cast("int").alias("employee_count"),
        F.when(k % 5 == 0, F.lit(None)).otherwise(F.col("c_acctbal") * 1000).alias("revenue"),
        F.when(k % 10 == 0, F.lit(None)).when(k % 23 == 0, F.lit(1066)).otherwise(1850 + k % 170).cast("int").alias("founded_year"),
        F.when(k % 8 == 0, F.lit("")).when(k % 8 == 1, F.lit("kaggle: list")).otherwise(F.lit("global")).alias("source_system"),
        F.when(k % 5 == 3, F.lit("n/a")).when(k % 2 == 0, F.lit("2024-03-05T06:07:08.123456"))
         .otherwise(F.concat(F.lit("2024-03-0"), _s(k % 9 + 1), F.lit("T06:07:08"))).alias("last_updated_at"))
    nation = F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    suppliers = (sup.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
                 .select(F.col("s_name").alias("company_name"),
                         F.lit(None).cast("string").alias("domain"),
                         F.lit(None).cast("string").alias("industry"),
                         F.col("n_name").alias("country"),
                         F.lit(None).cast("int").alias("employee_count"),
                         F.col("s_acctbal").alias("revenue"),
                         (1900 + F.col("s_suppkey") % 100).cast("int").alias("founded_year"),
                         F.lit("suppliers").alias("source_system"),
                         F.lit("2024-01-02T03:04:05").alias("last_updated_at")))
    both = cust.unionByName(suppliers)
    return both.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in STG_SECONDARY.fields])
