import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from firmo.operators import aggregates as AG
from firmo.operators import edits as ED
from firmo.operators import enrich as EN
from firmo.operators import profile as PF
from firmo.operators import quality as DQ
from firmo.operators.numbering import batch_ids, global_row_number


def test_global_row_number_independent_of_partitioning(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k"), (F.col("id") % 3).alias("g"))
    for parts in (1, 3, 17):
        got = global_row_number(df.repartition(parts), [F.col("g"), F.col("k")], "rn") \
            .orderBy("rn").select("g", "k").collect()
        exp = sorted((r.g, r.k) for r in df.collect())
        assert [(r.g, r.k) for r in got] == exp
    b = batch_ids(df, [F.col("k")], 100).groupBy("batch_num").count().collect()
    assert len(b) == 50 and all(r["count"] == 100 for r in b)


def test_exact_quantiles_match_numpy_linear(spark):
    rng = np.random.default_rng(3)
    rows = [(f"g{i % 3}", float(v)) for i, v in enumerate(rng.normal(size=901))]
    df = spark.createDataFrame(rows, "column_name string, value double").repartition(5)
    q = {(r.column_name, r.prob): r.quantile for r in PF.exact_quantiles(df, ["column_name"], [0.0, 0.25, 0.5, 0.9, 1.0]).collect()}
    for g in ("g0", "g1", "g2"):
        vals = np.array([v for k, v in rows if k == g])
        for p in (0.0, 0.25, 0.5, 0.9, 1.0):
            assert abs(q[(g, p)] - np.quantile(vals, p)) < 1e-12


def test_histogram_constant_column_and_last_edge(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 0.0), ("b", 10.0), ("b", 5.0)], "column_name string, value double")
    h = {(r.column_name, r.bin): r for r in PF.histogram(df, 50).collect()}
    assert h[("a", 25)]["count"] == 2 and h[("a", 0)].bin_low == 0.5      # range [v-0.5, v+0.5]
    assert h[("b", 49)]["count"] == 1 and h[("b", 0)]["count"] == 1 and h[("b", 25)]["count"] == 1
    assert sum(r["count"] for k, r in h.items() if k[0] == "b") == 3 and len(h) == 100


def test_corr_constant_and_pairwise_complete(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.1, 5.0), (3.0, None, 5.0), (4.0, 8.0, 5.0)], "x double, y double, c double")
    m = {(r.col_a, r.col_b): r.corr for r in PF.corr_matrix(df, ["x", "y", "c"]).collect()}
    assert m[("c", "x")] is None                                      # zero variance -> null, no error
    assert abs(m[("y", "x")] - np.corrcoef([1, 2, 4], [2, 4.1, 8])[0, 1]) < 1e-6


def test_kde_matches_direct_sum(spark):
    vals = [1.0, 2.0, 2.5, 7.0]
    df = spark.createDataFrame([("m", v) for v in vals], "column_name string, value double")
    out = PF.kde_grid(df, ["column_name"], points=5).orderBy("i").collect()
    n, sd = len(vals), np.std(vals, ddof=1)
    h = sd * n ** -0.2
    x = out[2].x
    dens = np.sum(np.exp(-0.5 * ((x - np.array(vals)) / h) ** 2)) / (n * h * np.sqrt(2 * np.pi))
    assert abs(out[2].count_density - round(dens * n * 6.0 / 50, 4)) < 1e-3


def test_employee_buckets_edges_and_nulls(spark):
    mart = spark.createDataFrame([(None,), (0,), (9999,), (10000,), (50000,), (200000,)], "employee_count long")
    got = [(r.bucket, r["count"]) for r in AG.employee_buckets(spark, mart).collect()]
    assert got == [("0-10K", 2), ("10K-50K", 1), ("50K-100K", 1), ("100K-200K", 0), ("200K+", 1)]
    got = [r["count"] for r in AG.employee_buckets(spark, mart, null_bucket=True).collect()]
    assert got[0] == 3


def test_expectations_unique_nulls_threshold(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), ("c",), (None,), ("d",), ("e",), ("f",), ("g",)], "k string")
    res = {r.check: r for r in DQ.validate(spark, df, [DQ.expect_unique("k", 0.5), DQ.expect_not_null("k", 0.9),
                                                         DQ.expect_column_exists("zz")]).collect()}
    assert res["unique"].evaluated == 9 and res["unique"].unexpected == 3 and res["unique"].success
    assert res["not_null"].unexpected == 1 and res["not_null"].success          # exactly at 0.9
    assert not res["exists"].success
    lim = DQ.dataset_limits(df, max_rows=5).first()
    assert lim.n_rows == 10 and not lim.success


def test_infobox_extraction(spark):
    html = ('<html><table class="infobox vcard"><tr><th>Type</th><td>Public</td></tr>'
            '<tr><th>Website</th><td><a href="https://www.apple.com/">apple.com</a></td></tr>'
            '<tr><th>Industry</th><td>Hardware</td></tr><tr><th>Industry</th><td>Software</td></tr>'
            '<tr><th>Founded</th><td>1 April 1976; 49 years ago</td></tr>'
            '<tr><th>Number of employees</th><td>161,000 (2024)</td></tr>'
            '<tr><th>Revenue</th><td>US$ 391 billion</td></tr>'
            '<tr><th>Headquarters</th><td>Toronto, Canada</td></tr>'
            '<tr><th>Location</th><td>Cork, UK &amp; Canada</td></tr>'
            '<tr><th>Headquarters</th><td>Cupertino, California, U.S.</td></tr></table></html>')
    pages = spark.createDataFrame([(1, html), (2, "<p>no table</p>")], "page_id long, html string")
    r = EN.extract_infobox(pages).collect()
    assert len(r) == 1
    r = r[0]
    assert (r.domain, r.industry, r.founded_year, r.employee_count, r.revenue, r.country) == \
        ("apple.com", "Software", 1976, 161000, 391e9, "UK")     # last row naming one; 'U.S.' is not listed (Q14)


def test_json_responses(spark):
    rows = [(1, '```json\n{"A": 1900, "B": null}\n```'), (2, '{"A": 1901}'), (3, '{"C": 19'),
            (4, 'Sure:\n```\n{"D": 2000}\n```')]
    got = {r.company_name: r.founded_year for r in
           EN.parse_json_responses(spark.createDataFrame(rows, "batch_num int, response_text string")).collect()}
    assert got == {"A": 1901, "B": None, "D": 2000}


def test_edit_replay_and_undo(spark):
    base = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "row_id long, name string, city string")
    edits = spark.createDataFrame([
        (1, "set", 1, "name", "a1"), (2, "set", 1, "name", "a2"), (3, "set", 2, "city", "y1"),
        (4, "delete", 2, None, None), (5, "add", 10, None, None), (6, "set", 10, "city", "new")],
        "seq long, op string, row_id long, column string, value string")
    now = {r.row_id: (r.name, r.city) for r in ED.apply_edits(base, edits, ["name", "city"]).collect()}
    assert now == {1: ("a2", "x"), 10: ("", "new")}
    back = {r.row_id: (r.name, r.city) for r in ED.edits_as_of(base, edits, ["name", "city"], 1).collect()}
    assert back == {1: ("a1", "x"), 2: ("b", "y")}


def test_approximate_quantiles_close_to_exact(spark):
    rng = np.random.default_rng(5)
    rows = [("g", float(v)) for v in rng.normal(size=2000)]
    df = spark.createDataFrame(rows, "column_name string, value double")
    approx = PF.approximate_quantiles(df, ["column_name"], {"q1": 0.25, "q3": 0.75}).first()
    vals = np.array([v for _, v in rows])
    assert abs(approx.q1 - np.quantile(vals, 0.25)) < 0.01 and abs(approx.q3 - np.quantile(vals, 0.75)) < 0.01


def _by_key(df, keys, column):
    return {tuple(r[k] for k in keys): r[column] for r in df.collect()}


@pytest.mark.parametrize("fetch", [1_000_000, 3])
def test_selection_by_refinement_equals_sorting(spark, monkeypatch, fetch):
    """Hot, tiny, huge, negative, null and infinite values; a null group; with 3 rows a
    fetch, intervals are cut until they are as small as that."""
    monkeypatch.setattr(PF, "FETCH_ROWS", fetch)
    rng = np.random.default_rng(7)
    sets = {
        "heavy": list(np.exp(rng.normal(18, 6, 500))), "tiny": list(rng.normal(0, 1e-9, 300)),
        "hot": [4.0] * 400 + list(rng.random(60)), "signs": [float(x) for x in rng.integers(-50, 50, 301)],
        "one": [2.5], "two": [-1.0, 8.0], "ends": [-math.inf, 1.0, 2.0, 3.0, math.inf], None: list(rng.random(41)),
        "close": list(1e12 + np.arange(200) / 64),
    }
    rows = [(g, float(v)) for g, vs in sets.items() for v in vs] + [("heavy", None), ("void", None)]
    rng.shuffle(rows)
    df = spark.createDataFrame([(r[0], None if r[1] is None else float(r[1])) for r in rows], "g string, value double").repartition(5)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = _by_key(PF.exact_quantiles(df, ["g"], probs), ["g", "prob"], "quantile")
    assert {g for g, _ in got} == set(sets)
    for g, vs in sets.items():
        vs = sorted(vs)
        for p in probs:
            pos = p * (len(vs) - 1)
            lo, hi = vs[math.floor(pos)], vs[math.ceil(pos)]
            want = lo if lo == hi else lo + (hi - lo) * (pos - math.floor(pos))
            assert got[g, p] == want or math.isnan(want) and math.isnan(got[g, p]), (g, p)


def test_selection_joins_many_groups_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(PF, "SENT_SPANS", 0)
    df = spark.range(600).selectExpr("id % 40 AS g", "CAST(id * id % 97 AS DOUBLE) AS value")
    got = _by_key(PF.exact_quantiles(df, ["g"], [0.3, 0.5]), ["g", "prob"], "quantile")
    for g in range(40):
        vs = [float(i * i % 97) for i in range(600) if i % 40 == g]
        assert got[g, 0.3] == pytest.approx(np.quantile(vs, 0.3), abs=1e-12) and got[g, 0.5] == pytest.approx(np.quantile(vs, 0.5), abs=1e-12)


def test_selection_of_no_rows(spark):
    none = spark.createDataFrame([], "g string, value double")
    assert PF.exact_quantiles(none, ["g"], [0.5]).collect() == []
    nan = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", float("nan"))], "g string, value double")
    got = _by_key(PF.exact_quantiles(nan, ["g"], [0.5, 1.0]), ["g", "prob"], "quantile")
    assert got["a", 0.5] == 2.0 and math.isnan(got["a", 1.0])


@pytest.mark.parametrize("cut,points", [(0.0, 200), (2.0, 100), (3.0, 50)])
def test_density_by_boxes_equals_direct_sum(spark, cut, points):
    """A far outlier leaves grid points out of reach of every box: they are listed with 0."""
    rng = np.random.default_rng(3)
    sets = {"normal": rng.normal(10, 3, 700), "far": np.append(rng.normal(0, 1, 300), 4000.0), "two": np.array([1.0, 2.0]),
            "skew": np.exp(rng.normal(0, 2, 400))}
    df = spark.createDataFrame([(g, float(v)) for g, vs in sets.items() for v in vs] + [("flat", 1.0), ("flat", 1.0)], "g string, value double")
    got = {(r["g"], r["i"]): r for r in PF.kde_grid(df, ["g"], points=points, cut=cut).collect()}
    assert len(got) == points * len(sets)
    for g, vs in sets.items():
        h = vs.std(ddof=1) * len(vs) ** -0.2
        x = vs.min() - cut * h + np.arange(points) * (vs.max() - vs.min() + 2 * cut * h) / (points - 1)
        dens = np.exp(-0.5 * ((x[:, None] - vs[None, :]) / h) ** 2).sum(axis=1) / (h * math.sqrt(2 * math.pi)) * (vs.max() - vs.min()) / 50
        for i in range(points):
            assert abs(got[g, i]["count_density"] - dens[i]) < 6e-5 and abs(got[g, i]["x"] - x[i]) < 1e-6
