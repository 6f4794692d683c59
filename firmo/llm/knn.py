"""Exact top-k search by a Voronoi join.

Vectors are dealt to the cells of their nearest pivots.  Small summaries of the
cells (farthest member, range of norms, the distances of the members nearest to
the pivot) give, for each cell of queries, a score that its k-th result reaches
at least, and for each pair of cells a score that no inner product exceeds.
Only data cells whose upper bound reaches the lower bound go to a query cell,
in blocks of bounded size; each unit (a block of queries, a block of data) is
solved alone, and the best k of all units are kept.

Equal vectors are one entry with its k + 1 smallest ids, which is all that a
top k can show of them: a vector shared by a third of all rows costs no more
than another.  Scores are exact integers; ties go to the smaller id.

Edge cases: vectors that are null, or hold a null or a component that is not
finite, take no part; an empty vector scores 0 with all; of vectors of unequal
length the shorter counts as padded with zeros; rows with a null id take no
part; repeated rows of one id are one row, and of unequal vectors of one id the
smallest takes part (compared component by component, after quantising); a query with fewer other rows than k
returns them all; an empty table gives no rows."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from firmo.llm.common import column, pick, written

QUERY_BLOCK = 2048
DATA_BLOCK = 8192
CELL = 4096
MAX_PIVOTS = 1024
EXACT = float(1 << 53)


def _quantised(col: pa.Array, scale: float, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that take part, and their floor(scale * x) as doubles, padded to width."""
    rows, out = [], []
    for i, v in enumerate(col.to_pylist()):
        if v is None or any(x is None for x in v):
            continue
        x = np.floor(scale * np.asarray(v, dtype=np.float64))
        if np.isfinite(x).all():
            rows.append(i)
            out.append(np.pad(x, (0, width - len(x))) + 0.0)
    return np.array(rows, dtype=np.int64), np.stack(out) if out else np.zeros((0, width))


def _batch(col: pa.Array, scale: float, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The same for a batch of whole rows of equal length at once, where it is one."""
    flat = col.flatten()
    if col.null_count == 0 and flat.null_count == 0 and width and len(flat) == len(col) * width:
        n = np.asarray(col.value_lengths())
        if (n == width).all():
            x = np.floor(scale * np.asarray(flat).astype(np.float64).reshape(len(col), width)) + 0.0
            ok = np.flatnonzero(np.isfinite(x).all(1))
            return ok, x[ok]
    return _quantised(col, scale, width)


def _scores(q: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Integer inner products, exactly."""
    if not q.size or not d.size:
        return np.zeros((len(q), len(d)), dtype=np.int64)
    if np.abs(q).max() * np.abs(d).max() * q.shape[1] < EXACT:
        return np.rint(q @ d.T).astype(np.int64)
    big = [[int(x) for x in row] for row in d]
    return np.array([[sum(int(a) * b for a, b in zip(row, other, strict=True)) for other in big] for row in q], dtype=np.int64)


def _distance(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    d = (x ** 2).sum(1)[:, None] + (p ** 2).sum(1)[None, :] - 2 * (x @ p.T)
    return np.sqrt(np.maximum(d, 0))


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row the k best (score, smaller id first); ids ascend along the columns."""
    n = scores.shape[1]
    if n > k:
        # a strict order in one number: the score, then the place
        top = scores.max(initial=0)
        if max(abs(int(top)), abs(int(scores.min(initial=0)))) < (1 << 62) // n:
            code = scores * n + (n - 1 - np.arange(n))
            at = np.argpartition(-code, k - 1, axis=1)[:, :k]
            at = np.take_along_axis(at, np.argsort(-np.take_along_axis(code, at, 1), axis=1), 1)
        else:
            at = np.stack([np.lexsort((np.arange(n), [-int(s) for s in row]))[:k] for row in scores])
    else:
        at = np.argsort(-scores, axis=1, kind="stable")
    return np.take_along_axis(scores, at, 1), ids[at] if ids.ndim == 1 else at


def bounds(cells: dict[int, dict], pivots: np.ndarray, k: int, slack: float = 1e-6) -> list[tuple[int, int]]:
    """Pairs (query cell, data cell) that may share a result.  ``cells`` holds for
    each cell: q_far, q_lo, q_hi (queries: farthest from the pivot, range of
    norms) where it has queries; far, lo, hi (data) and ``near``, the distances
    of its k nearest members to the pivot."""
    out = []
    gap = _distance(pivots, pivots)
    data = sorted(c for c in cells if cells[c].get("near"))
    for i in sorted(c for c in cells if "q_far" in cells[c]):
        q = cells[i]
        low = []
        for j in data:
            d = cells[j]
            # |q - x| is at most gap + q_far + distance, and 2 q.x = |q|^2 + |x|^2 - |q - x|^2
            low += [(q["q_lo"] ** 2 + d["lo"] ** 2 - (gap[i, j] + q["q_far"] + r) ** 2) / 2 for r in d["near"]]
        low.sort(reverse=True)
        least = low[k - 1] if len(low) >= k else -np.inf
        for j in data:
            d = cells[j]
            apart = max(0.0, gap[i, j] - q["q_far"] - d["far"])
            top = min((q["q_hi"] ** 2 + d["hi"] ** 2 - apart ** 2) / 2, q["q_hi"] * d["hi"])
            if top >= least - slack * (1 + abs(least)):
                out.append((i, j))
    return out


def join(vectors: DataFrame, is_query, k: int = 20, scale: float = 64.0, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, id, score: the k best others of each row for which the
    Column ``is_query`` holds, against all rows."""
    spark = vectors.sparkSession
    rows = (pick(vectors, id_col, vec_col).select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v"))
            .where("id IS NOT NULL AND v IS NOT NULL").withColumn("is_query", F.coalesce(is_query(F.col("id")), F.lit(False))))
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("w")).first()
    width, m = size["w"] or 0, max(8, min(MAX_PIVOTS, size["n"] // CELL))
    # pivots: a bounded sample, by the hash of the id
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(m).select("id", "v").toArrow()
    _, points = _quantised(sample.column("v").combine_chunks(), scale, width) if len(sample) else (None, np.zeros((0, width)))
    points = np.unique(points, axis=0) if len(points) else np.zeros((1, width))
    shared = spark.sparkContext.broadcast(points)           # at most MAX_PIVOTS vectors

    def assign(batches, scale=scale):
        p = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                b = whole.slice(at, 2048)
                keep, x = _batch(column(b, "v"), scale, width)
                if not len(keep):
                    continue
                d = _distance(x, p)
                cell = d.argmin(1)
                raw = [v.tobytes() for v in x]
                yield pa.RecordBatch.from_arrays(
                    [column(b, c).take(pa.array(keep)) for c in ("id", "is_query")]
                    + [pa.array([hashlib.blake2b(r, digest_size=16).digest() for r in raw], pa.binary()), pa.array(_packed(x), pa.binary()),
                       pa.array(cell.astype(np.int32)), pa.array(d[np.arange(len(d)), cell]), pa.array(np.sqrt((x ** 2).sum(1)))],
                    names=["id", "is_query", "key", "x", "cell", "dist", "norm"])

    columns = "id long, is_query boolean, key binary, x binary, cell int, dist double, norm double"
    dealt = written(rows.mapInArrow(assign, columns), "assigned")
    twice = written(dealt.groupBy("id").agg(F.min("key").alias("a"), F.max("key").alias("b")).where("a <> b").select("id"), "unequal")
    if not twice.isEmpty():
        # quantised already, so the scale is 1
        whole = F.transform("v", lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("double"))
        fit = ~F.exists("v", lambda x: F.coalesce(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(True)))
        least = rows.join(twice, "id", "left_semi").where(fit).groupBy("id", "is_query").agg(F.min(whole).alias("v"))
        one = least.select("id", "v", "is_query").mapInArrow(lambda batches: assign(batches, 1.0), columns)
        dealt = written(dealt.join(twice, "id", "left_anti").unionByName(one), "single")
    # k + 1 smallest ids of each vector; the limit holds before the shuffle already
    ids = dealt.select("id", "key").distinct()
    w = Window.partitionBy("key").orderBy("id")
    ids = ids.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k + 1).groupBy("key").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    entry = dealt.groupBy("key").agg(F.min("x").alias("x"), F.min("cell").alias("cell"), F.min("dist").alias("dist"), F.min("norm").alias("norm"), F.max("is_query").alias("is_query"))
    entry = written(entry.join(ids, "key"), "entries")

    far = entry.groupBy("cell").agg(F.max("dist").alias("far"), F.min("norm").alias("lo"), F.max("norm").alias("hi"), F.count(F.lit(1)).alias("n"))
    mark = F.col("is_query")
    qfar = entry.where(mark).groupBy("cell").agg(F.max("dist").alias("q_far"), F.min("norm").alias("q_lo"), F.max("norm").alias("q_hi"), F.count(F.lit(1)).alias("nq"))
    near = (entry.select("cell", "dist", "key").withColumn("r", F.row_number().over(Window.partitionBy("cell").orderBy("dist", "key")))
            .where(F.col("r") <= k + 1).groupBy("cell").agg(F.collect_list("dist").alias("near")))
    cells = {r["cell"]: {c: v for c, v in r.asDict().items() if v is not None} for r in far.join(near, "cell").join(qfar, "cell", "left").collect()}
    pairs = bounds(cells, points, k + 1)
    split = {c: max(1, -(-v["n"] // DATA_BLOCK)) for c, v in cells.items()}
    split_q = {c: max(1, -(-v.get("nq", 0) // QUERY_BLOCK)) for c, v in cells.items()}
    # query cells that need the same data are solved together, up to a block
    groups: list[tuple[list[int], int]] = []
    needs: dict[int, set[int]] = {}
    for i, j in pairs:
        needs.setdefault(i, set()).add(j)
    for i in sorted(needs, key=lambda c: (sorted(needs[c]), c)):
        n = cells[i]["nq"]
        if groups and split_q[i] == 1 and groups[-1][1] + n <= QUERY_BLOCK and needs[groups[-1][0][0]] == needs[i]:
            groups[-1] = ([*groups[-1][0], i], groups[-1][1] + n)
        else:
            groups.append(([i], n))
    group_of = {i: g for g, (members, _) in enumerate(groups) for i in members}
    parts = {g: split_q[members[0]] for g, (members, _) in enumerate(groups)}
    plan = [(i, group_of[i], parts[group_of[i]]) for i in needs]
    reach = sorted({(group_of[i], j, split[j], parts[group_of[i]]) for i, j in pairs})
    if not reach:
        return spark.createDataFrame([], "query_id long, rank int, id long, score long")
    q_plan = spark.createDataFrame(plan, "cell int, g int, parts int")       # one row per cell
    d_plan = spark.createDataFrame([(c, n) for c, n in split.items()], "cell int, blocks int")
    units = (spark.createDataFrame(reach, "g int, cell int, blocks int, parts int")
             .withColumn("b", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("p", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("g", "cell", "b", "p"))
    h = F.xxhash64("key")
    qs = (entry.where(mark).join(F.broadcast(q_plan), "cell").select("key", "x", "g", F.pmod(h, F.col("parts")).cast("int").alias("p")))
    ds = (entry.join(F.broadcast(d_plan), "cell").select("cell", F.pmod(h, F.col("blocks")).cast("int").alias("b"), "ids", "x"))

    def pack_q(t):
        return pa.table({"g": t["g"][:1], "p": t["p"][:1], "keys": pa.array([t["key"].to_pylist()], pa.list_(pa.binary())), "qx": pa.array([t["x"].to_pylist()], pa.list_(pa.binary()))})

    def pack_d(t):
        t = t.append_column("first", pa.array([v[0] for v in t["ids"].to_pylist()], pa.int64())).sort_by("first")
        return pa.table({"cell": t["cell"][:1], "b": t["b"][:1], "ids": pa.array([t["ids"].to_pylist()], pa.list_(pa.list_(pa.int64()))), "dx": pa.array([t["x"].to_pylist()], pa.list_(pa.binary()))})

    q_packs = qs.groupBy("g", "p").applyInArrow(pack_q, "g int, p int, keys array<binary>, qx array<binary>")
    d_packs = ds.groupBy("cell", "b").applyInArrow(pack_d, "cell int, b int, ids array<array<bigint>>, dx array<binary>")
    q_packs, d_packs = written(q_packs, "query-blocks"), written(d_packs, "data-blocks")
    work = q_packs.join(units, ["g", "p"]).join(d_packs, ["cell", "b"]).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))

    def solve(batches):
        for whole in batches:
            for at in range(whole.num_rows):
                r = whole.slice(at, 1)
                keys, ids = column(r, "keys").to_pylist()[0], column(r, "ids").to_pylist()[0]
                q, d = _unpacked(column(r, "qx").to_pylist()[0]), _unpacked(column(r, "dx").to_pylist()[0])
                for lo in range(0, len(q), 256):
                    s, place = _best(_scores(q[lo:lo + 256], d), np.zeros((0, 0)), k + 1)
                    out_k, out_i, out_s = [], [], []
                    for key, row, where in zip(keys[lo:lo + 256], s.tolist(), place.tolist(), strict=True):
                        got = sorted((-x, i) for x, e in zip(row, where, strict=True) for i in ids[e])[:k + 1]
                        out_k += [key] * len(got)
                        out_i += [i for _, i in got]
                        out_s += [-x for x, _ in got]
                    yield pa.RecordBatch.from_arrays([pa.array(out_k, pa.binary()), pa.array(out_i, pa.int64()), pa.array(out_s, pa.int64())], names=["key", "id", "score"])

    found = work.select("keys", "qx", "ids", "dx").mapInArrow(solve, "key binary, id long, score long")
    best = (found.withColumn("r", F.row_number().over(Window.partitionBy("key").orderBy(F.desc("score"), "id"))).where(F.col("r") <= k + 1)
            .groupBy("key").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), F.col("id").alias("id")))).alias("best")))
    asked = dealt.where("is_query").select(F.col("id").alias("query_id"), "key").distinct()
    own = F.slice(F.filter("best", lambda x: x["id"] != F.col("query_id")), 1, k)
    return (asked.join(best, "key").select("query_id", F.posexplode(own).alias("pos", "hit"))
            .select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("hit.id").alias("id"), (-F.col("hit.s")).alias("score")))


def _packed(x: np.ndarray) -> list[bytes]:
    """Vectors as bytes, in the smallest integer type that holds the batch's values."""
    top = np.abs(x).max(initial=0)
    for code, kind in ((b"\1", np.int8), (b"\2", np.int16), (b"\4", np.int32)):
        if top <= np.iinfo(kind).max:
            return [code + v.tobytes() for v in x.astype(kind)]
    return [b"\x08" + v.tobytes() for v in x]


def _unpacked(raw: list[bytes]) -> np.ndarray:
    kinds = {1: np.int8, 2: np.int16, 4: np.int32, 8: np.float64}
    first = raw[0][0]
    if all(r[0] == first for r in raw):
        return np.frombuffer(b"".join(r[1:] for r in raw), dtype=kinds[first]).reshape(len(raw), -1).astype(np.float64)
    return np.stack([np.frombuffer(r[1:], dtype=kinds[r[0]]).astype(np.float64) for r in raw])


def query(vectors: DataFrame) -> DataFrame:
    """Queries are the rows whose vec_id is divisible by 20."""
    out = join(vectors, lambda i: i % 20 == 0, k=20)
    return out.select("query_id", "rank", F.col("id").alias("vec_id"), "score")
