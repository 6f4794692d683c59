import numpy as np
import pytest
from pyspark.sql import functions as F

from firmo.llm import knn


def brute(rows, k=20, every=20):
    ok = {}
    width = max((len(v) for _, v in rows if v is not None), default=0)
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            ok[i] = [int(np.floor(64 * float(np.float32(x)))) for x in v] + [0] * (width - len(v))
    out = []
    for q, x in ok.items():
        if q % every == 0:
            s = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in ok.items() if i != q)[:k]
            out += [(q, r + 1, i, -n) for r, (n, i) in enumerate(s)]
    return sorted(out)


def run(spark, rows):
    df = spark.createDataFrame([(i, v, 3, "x") for i, v in rows], "vec_id long, embedding array<float>, label int, score string")
    return sorted(tuple(r) for r in knn.query(df).collect())


def vectors(n, seed=0, centres=6):
    r = np.random.default_rng(seed)
    c = r.normal(0, 1, (centres, 8))
    return [(i, (c[i % centres] + r.normal(0, 0.05, 8)).astype(np.float32).tolist()) for i in range(n)]


@pytest.mark.parametrize("cell, block", [(4096, 8192), (20, 16)])
def test_equals_brute_force(spark, monkeypatch, cell, block):
    monkeypatch.setattr(knn, "CELL", cell)
    monkeypatch.setattr(knn, "DATA_BLOCK", block)
    monkeypatch.setattr(knn, "QUERY_BLOCK", block)
    rows = vectors(300)
    assert run(spark, rows) == brute(rows)


def test_one_vector_holds_most_rows(spark):
    rows = vectors(60) + [(i, [0.5] * 8) for i in range(60, 400)]
    assert run(spark, rows) == brute(rows)


def test_edges(spark):
    v = [0.25, -0.5]
    rows = [(0, v), (20, v), (20, v), (1, None), (2, [None, 1.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, []),
            (6, [1.0]), (None, v), (40, [3e4, -3e4]), (60, [0.0, 0.0])]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []
    assert run(spark, [(20, v)]) == []


def test_bounds_drop_cells_that_cannot_matter():
    r = np.random.default_rng(2)
    pivots = np.array([[100.0, 0], [-100, 0], [0, 100], [0, -100]])
    x = [p + r.normal(0, 1, (50, 2)) for p in pivots]
    cells = {}
    for c, pts in enumerate(x):
        d = np.linalg.norm(pts - pivots[c], axis=1)
        n = np.linalg.norm(pts, axis=1)
        cells[c] = {"far": d.max(), "lo": n.min(), "hi": n.max(), "near": sorted(d)[:5], "q_far": d.max(), "q_lo": n.min(), "q_hi": n.max()}
    assert knn.bounds(cells, pivots, 5) == [(0, 0), (1, 1), (2, 2), (3, 3)]


def test_general_interface(spark):
    df = spark.createDataFrame(vectors(50), "name long, v array<float>")
    got = knn.join(df, lambda i: i == 7, k=3, scale=1000.0, id_col="name", vec_col="v")
    assert got.columns == ["query_id", "rank", "id", "score"]
    assert [r["rank"] for r in got.orderBy("rank").collect()] == [1, 2, 3]
    assert got.where(F.col("id") == 7).count() == 0


def test_unequal_vectors_of_one_id(spark):
    rows = vectors(60)
    other = [(i, [x + d for x in v]) for (i, v), d in zip(rows[:25], [0.5, -0.5, 0.0] * 9)] + [(20, [float("nan")] * 8), (3, None)]
    best = {}
    for i, v in rows + other:
        if v is not None and np.isfinite(v).all():
            q = [int(np.floor(64 * float(np.float32(x)))) for x in v]
            best[i] = min(best.get(i, (q, v)), (q, v), key=lambda p: p[0])
    got = run(spark, rows + other)
    assert got == brute([(i, v) for i, (_, v) in best.items()])
    assert len({r[:2] for r in got}) == len(got)
