"""Layer semantics on literal staging rows, and equivalence of the pre-reduced
raw dimension with the model's naive join + row_number on random data."""

import datetime as dt
import random

from pyspark.sql import Window, functions as F

from firmo.operators import clean
from firmo.params import RunParams
from firmo.plans import layers as LY
from firmo.schemas import STG_PRIMARY, STG_SECONDARY

P = RunParams(dt.date(2001, 6, 30), dt.datetime(2001, 7, 1))


def primary(spark, rows):
    base = {f.name: None for f in STG_PRIMARY.fields}
    return spark.createDataFrame([{**base, **r} for r in rows], STG_PRIMARY)


def secondary(spark, rows):
    base = {f.name: None for f in STG_SECONDARY.fields}
    return spark.createDataFrame([{**base, **r} for r in rows], STG_SECONDARY)


def test_fact_defaults_rank_window_and_dates(spark):
    d = dt.date
    p = primary(spark, [
        dict(company="a", ticker="t1", country="x", rank=None, revenues_m=None, updated=None),
        dict(company="b", ticker="t2", country="x", rank=1500, number_of_employees=-5, revenues_m=2.0,
             updated=d(1990, 6, 29)),
        dict(company="c", ticker="t3", country="x", rank=3, revenues_m=1.0, updated=d(1991, 6, 30)),
        dict(company="e", ticker="t4", country="x", rank=4, updated=d(2001, 7, 1)),
        dict(company="  ", ticker="t5", country="x", rank=5),
    ])
    raw = LY.raw_fct_company_metrics(p, P)
    r = {x.company_name: x for x in raw.collect()}
    assert set(r) == {"A", "B", "C", "E"}                 # blank company dropped
    assert r["A"].fortune_rank == 0 and r["A"].revenue_millions == 0.0 and r["A"].metric_date == d(2001, 6, 30)
    assert r["B"].revenue_millions == 2e6                  # millions -> dollars (Q1)
    b = {x.company_name: x for x in LY.bronze_fct_company_metrics(raw, P).collect()}
    assert b["A"].fortune_rank is None                     # 0 fails 1..1000 (Q3)
    assert b["B"].fortune_rank is None and b["B"].employee_count is None
    assert b["B"].metric_date == d(2001, 6, 30)            # 11 years before -> as-of
    assert b["C"].metric_date == d(1991, 6, 30)            # exactly 10 years before is kept
    assert b["E"].metric_date == d(2001, 6, 30)            # after as-of -> as-of


def test_dimension_enrichment_and_unknowns(spark):
    p = primary(spark, [dict(company=" Acme ", ticker="", sector="  ", industry=None, country="nation_1",
                             website=None, rank=1),
                        dict(company="Solo", ticker="S", sector="Tech", industry="Soft", country=None, rank=2)])
    s = secondary(spark, [dict(company_name="acme", domain="acme.net", country="NATION_1", founded_year=1900,
                               source_system="", last_updated_at="2024-03-05T06:07:08"),
                          dict(company_name="acme", domain="acme.org", country="nation_1", founded_year=None,
                               source_system="global", last_updated_at="2025-01-01T00:00:00"),
                          dict(company_name="Other", domain="o.com", country="Z", founded_year=1066,
                               source_system="global", last_updated_at="bad")])
    rows = {r.company_name: r for r in LY.raw_dim_companies(p, s, P).collect()}
    assert set(rows) == {"ACME", "SOLO", "OTHER"}
    a = rows["ACME"]
    assert a.website == "acme.net" and a.founded_year == 1900      # founded year present wins over newer
    assert a.ticker == "UNKNOWN" and a.sector == "UNKNOWN" and a.industry == "UNKNOWN"
    assert a.source_system == clean.PRIMARY_SOURCE
    assert rows["SOLO"].country == "UNKNOWN"
    o = rows["OTHER"]
    assert o.loaded_at == P.run_ts and o.founded_year == 1066
    bronze = {r.company_name: r for r in LY.bronze_dim_companies(LY.raw_dim_companies(p, s, P), P).collect()}
    assert bronze["OTHER"].founded_year is None                     # before 1800
    assert bronze["SOLO"].country is None                           # UNKNOWN -> null


def naive_raw_dim(p, s, params):
    """The model's own form: join with fan-out, union, row_number over the full order."""
    f = clean.primary_dim_project(p, params)
    g = clean.secondary_dim_project(s, params)
    gs = g.select("company_name", "country", F.col("website").alias("_sw"), F.col("founded_year").alias("_gf"),
                  F.col("loaded_at").alias("_sl"))
    enriched = (f.join(gs, ["company_name", "country"], "left")
                 .withColumn("_pw", F.col("website"))
                 .withColumn("website", F.coalesce("website", "_sw"))
                 .withColumn("founded_year", F.coalesce("_gf", "founded_year")).drop("_gf"))
    alone = (g.join(f.select("company_name", "country"), ["company_name", "country"], "left_anti")
              .withColumn("_pw", F.lit(None).cast("string")).withColumn("_sw", F.col("website"))
              .withColumn("_sl", F.col("loaded_at")))
    u = clean.default_unknown(enriched.unionByName(alone))
    fl = lambda c: F.when(c, 0).otherwise(1)
    kag = F.col("source_system").like("kaggle:%")
    order = [fl(F.col("founded_year").isNotNull()), fl(F.col("ticker") != "UNKNOWN"), fl(F.col("sector") != "UNKNOWN"),
             fl(F.col("employee_count") > 0), fl(F.col("revenue") > 0),
             F.when(kag & F.col("founded_year").isNotNull(), 0).when(kag, 1).otherwise(2),
             F.col("loaded_at").desc_nulls_last(), F.col("_sl").desc_nulls_last()] + \
            [F.col(c).asc_nulls_last() for c in ["_sw", "founded_year", "ticker", "sector", "industry",
                                                 "headquarters_city", "headquarters_state", "ceo", "_pw",
                                                 "source_system"]]
    w = Window.partitionBy("company_id", "company_name").orderBy(*order)
    return u.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn", "_pw", "_sw", "_sl")


def test_pre_reduced_dimension_equals_naive_form(spark):
    rnd = random.Random(7)
    names = ["a", "b", "c", "d"]
    countries = ["x", "y", None, ""]
    prim = [dict(company=rnd.choice(names), country=rnd.choice(countries), rank=i,
                 ticker=rnd.choice(["", "T1", "T2", None]), sector=rnd.choice(["", "S1", "S2"]),
                 industry=rnd.choice([None, "I1", "I2"]), headquarterscity=rnd.choice([None, "C1", "C2"]),
                 ceo=rnd.choice([None, "P1"]), website=rnd.choice([None, "", "w1", "w2"]))
            for i in range(60)]
    sec = [dict(company_name=rnd.choice(names + ["e"]), country=rnd.choice(["x", "y", "z"]),
                domain=rnd.choice([None, "d1", "d2"]), industry=rnd.choice([None, "J1"]),
                founded_year=rnd.choice([None, 1900, 1950]), source_system=rnd.choice(["", "g", "kaggle: k"]),
                last_updated_at=rnd.choice(["2024-01-01T00:00:00", "2024-01-02T00:00:00.5", "n/a"]))
           for _ in range(40)]
    p, s = primary(spark, prim), secondary(spark, sec)
    ours = LY.raw_dim_companies(p, s, P).drop("dim_created_at")
    ref = naive_raw_dim(p, s, P).select(*ours.columns)
    assert ours.count() == ref.count()
    assert ours.exceptAll(ref).count() == 0 and ref.exceptAll(ours).count() == 0


def test_founders_case_insensitive_and_deduplicated(spark):
    p = primary(spark, [dict(company="A", ticker="t", country="x", founder_is_ceo="yes", ceo=" Ann "),
                        dict(company="A", ticker="t", country="x", founder_is_ceo="YES", ceo="Bob"),
                        dict(company="B", ticker="u", country="x", founder_is_ceo="no", ceo="Cy")])
    s = secondary(spark, [dict(company_name="A", country="x")])
    rows = LY.bronze_dim_founder(p, s, P).collect()
    assert [(r.company_name, r.founder_name) for r in rows] == [("A", "Ann")]


def test_mart_fans_out_on_shared_name(spark):
    p = primary(spark, [dict(company="A", ticker="t1", country="x", rank=1, revenues_m=1.0),
                        dict(company="A", ticker="t2", country="y", rank=2, revenues_m=2.0)])
    s = secondary(spark, [])
    L = LY.Layers(p, s, P)
    assert L.mart.count() == 4          # 2 dimension rows x 2 fact keys (Q17)


def test_a_run_follows_its_source_tables(spark, tmpdir_path):
    import shutil

    from firmo.plans.runs import staged
    for t in ("customer", "nation", "orders", "supplier"):
        shutil.copyfile(f"/root/testdata/sf0.001/{t}.parquet", f"{tmpdir_path}/{t}.parquet")
    first = staged(spark, tmpdir_path)
    assert staged(spark, tmpdir_path) is first
    n = first.stg_secondary.count()
    shutil.copyfile("/root/testdata/sf0.01/supplier.parquet", f"{tmpdir_path}/supplier.parquet")
    again = staged(spark, tmpdir_path)
    assert again is not first and again.stg_secondary.count() > n
    import os
    assert not os.path.exists(first.root.removeprefix("file:"))
