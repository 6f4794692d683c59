"""The join of the mart at size: no side sent whole, a hot name over several tasks,
and no table written that the query does not read."""

import os
import shutil
from collections import Counter

import pytest
from pyspark.sql import functions as F

from firmo import catalog
from firmo.operators import joins
from firmo.plans.runs import staged


@pytest.fixture()
def no_coalesce(spark):
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, old)


def _tables(spark):
    dims = [(f"d{i}", "HUB") for i in range(30)] + [("x", "ONE"), ("y", "NONE"), ("z", " "), ("n", None), ("y", "NONE")]
    facts = [(f"f{i}", "HUB") for i in range(300)] + [(None, "HUB"), ("a", "ONE"), ("b", "ONE"), ("c", "OTHER"), ("d", None)]
    dim = spark.createDataFrame(dims, "company_id string, company_name string")
    fct = spark.createDataFrame([(i, n, k) for k, (i, n) in enumerate(facts)], "company_id string, company_name string, v long")
    return dims, facts, dim, fct


@pytest.mark.parametrize("hot", [1, 7, 299, 4096])
def test_parts_of_a_hot_name_give_the_plain_join(spark, monkeypatch, hot):
    monkeypatch.setattr(joins, "HOT", hot, raising=False)
    dims, facts, dim, fct = _tables(spark)
    want = Counter()
    for i, name in dims:
        if name and name.strip():
            met = [k for k, (_, n) in enumerate(facts) if n == name]
            want.update((name, i, k) for k in met or [None])
    got = joins.mart_join(dim, fct)
    assert got.columns == ["company_name", "company_id", "v"]
    assert Counter(tuple(r) for r in got.collect()) == want


def test_a_hot_name_is_joined_by_several_tasks_and_nothing_is_sent_whole(spark, monkeypatch, no_coalesce):
    monkeypatch.setattr(joins, "HOT", 20, raising=False)
    _, _, dim, fct = _tables(spark)
    out = joins.mart_join(dim, fct)
    per = out.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in per) < 0.7 * sum(r["count"] for r in per)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=merge" in plan


def test_tables_of_a_run_are_written_when_read(spark, tmpdir_path):
    for t in ("customer", "nation", "orders", "supplier"):
        shutil.copyfile(f"/root/testdata/sf0.001/{t}.parquet", f"{tmpdir_path}/{t}.parquet")
    catalog.QUERIES["mart_join"](spark, tmpdir_path).count()
    run = staged(spark, tmpdir_path)
    root = run.root.removeprefix("file:")
    assert sorted(os.listdir(root)) == ["stg_primary", "stg_secondary"]
    assert run.mart is staged(spark, tmpdir_path).mart
    assert sorted(os.listdir(root)) == ["raw_dim_companies", "raw_fct_company_metrics", "stg_primary", "stg_secondary",
                                        "unified_companies"]
