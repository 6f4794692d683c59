"""N-gram Jaccard join with Bayesian candidate pruning.

A text is the set of its runs of ``n`` words (lower-cased A-Z); a shorter text
with words is one run.  Texts with the same words in the same order are one
class, so copies never form pairs.  Classes that agree in a band of MinHash
values are candidates.  For each candidate pair MinHash values are compared a
few at a time; a pair is dropped as soon as the posterior probability that its
similarity reaches the threshold (uniform prior, binomial likelihood) falls
below ``tolerance``; the rest is verified exactly on the sets.  Of the pairs at
exactly 0.8 the bands miss 2.9e-7 and the pruning 6.2e-8, of those above fewer.

Nothing that grows with the square of a group leaves a task: candidate groups
with the same members are compared once; large groups are cut into blocks and
compared block by block; a task returns, for each member, the number of its
links and one edge of a spanning forest of the links it found.  A pair that
meets in several groups belongs to the one with the smallest key.

Edge cases: null and empty texts, and texts without words, have no links and
are classes of their own; copies (repeated rows too) count as links of each
other; rows with a null doc_id take part and get the class of their text; extra
columns are ignored; an empty table gives no rows."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from firmo.llm import rows as rows_
from firmo.llm.common import Words, blocks, column, mix, pick, utf8, written

HASHES = 64
BANDS, ROWS = 21, 3
STEP = 16
UNIT = 512               # members of a block
UNIT_RUNS = 1 << 20      # runs of words of a block, at most, beyond one member
BROADCAST_ROWS = 200_000

_rng = np.random.default_rng(20240613)
_A = _rng.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _runs(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of n words, and where those of each text begin."""
    h, counts = w.hashes(), w.counts
    size = np.maximum(counts - n + 1, np.minimum(counts, 1))
    first = np.concatenate([[0], np.cumsum(size)])
    at = np.arange(first[-1]) - np.repeat(first[:-1], size) + np.repeat(w.first[:-1], size)
    last = np.repeat(w.first[1:], size)
    out = np.zeros(len(at), dtype=np.uint64)
    for k in range(n):
        p = at + k
        inside = p < last
        out = mix(out * np.uint64(0xA24BAED4963EE407) + np.where(inside, h[np.minimum(p, len(h) - 1)] if len(h) else 0, np.uint64(k)).astype(np.uint64))
    return out, first


def _class_keys(w: Words) -> list[bytes | None]:
    """16 bytes for the word sequence of each text; None without words."""
    h = w.hashes()
    return [hashlib.blake2b(h[a:b].tobytes(), digest_size=16).digest() if b > a else None
            for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True)]


def _signatures(runs: np.ndarray, first: np.ndarray) -> np.ndarray:
    """MinHash values (uint32) of each text with runs; rows of texts without are 0."""
    some = np.flatnonzero(np.diff(first) > 0)
    sig = np.zeros((len(first) - 1, HASHES), dtype=np.uint32)
    if len(some):
        at = first[some]
        for j in range(HASHES):
            sig[some, j] = np.minimum.reduceat(((runs * _A[j]) >> np.uint64(32)).astype(np.uint32), at)
    return sig


def band_keys(sig: np.ndarray) -> np.ndarray:
    """Key of each band of each signature, as signed 64-bit."""
    out = np.empty((len(sig), BANDS), dtype=np.uint64)
    for b in range(BANDS):
        h = np.full(len(sig), b + 1, dtype=np.uint64)
        for r in range(ROWS):
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + sig[:, b * ROWS + r].astype(np.uint64))
        out[:, b] = h
    return out.view(np.int64)


def fewest_matches(threshold: float, tolerance: float) -> dict[int, int]:
    """For each number of compared values the fewest matches with which a pair
    stays: P(similarity >= threshold | m of n match) >= tolerance."""
    out = {}
    for n in range(STEP, HASHES + 1, STEP):
        for m in range(n + 1):
            # posterior Beta(m + 1, n - m + 1): the tail as a binomial sum
            tail = sum(comb(n + 1, j) * threshold ** j * (1 - threshold) ** (n + 1 - j) for j in range(m + 1))
            if tail >= tolerance:
                out[n] = m
                break
    return out


def sketch(docs: DataFrame, n: int, places: bool = False) -> DataFrame:
    """doc_id, key, sig of every whole text; with ``places`` also its file, position
    and a hash of the text, of a plain scan of files.  No shuffle."""
    more = ["file", "at", "said"] if places else []

    def run(batches):
        for b in blocks(batches, "text"):
            w = Words(utf8(column(b, "text")))
            keys = _class_keys(w)
            sig = _signatures(*_runs(w, n))
            yield pa.RecordBatch.from_arrays(
                [column(b, "doc_id"), pa.array(keys, pa.binary()), pa.array([s.tobytes() if k else None for s, k in zip(sig, keys, strict=True)], pa.binary()),
                 *[column(b, c) for c in more]], names=["doc_id", "key", "sig", *more])

    need = pick(docs, "doc_id", "text")
    if places:
        # the metadata belongs to the scan, before any other column is left out
        whole, file, at = rows_.placed(docs)
        need = whole.select("doc_id", "text", F.col(file).alias("file"), F.col(at).alias("at"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("said"))
    return need.mapInArrow(run, f"doc_id {dict(need.dtypes)['doc_id']}, key binary, sig binary" + (", file string, at long, said long" if places else ""))


def _bands(classes: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            keys = column(b, "key")
            if not len(keys):
                continue
            sig = np.frombuffer(b"".join(column(b, "sig").to_pylist()), dtype=np.uint32).reshape(-1, HASHES)
            yield pa.RecordBatch.from_arrays([pa.array(band_keys(sig).ravel()), keys.take(pa.array(np.repeat(np.arange(len(keys)), BANDS)))], names=["band", "key"])

    return classes.select("key", "sig").mapInArrow(run, "band long, key binary")


def _sets(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """key, copies, sig, n_runs, runs (sorted 64-bit hashes) of one text of each
    wanted class."""
    def run(batches):
        for b in blocks(batches, "text"):
            w = Words(utf8(column(b, "text")))
            runs, first = _runs(w, n)
            asked = column(b, "key").to_pylist()
            ok = [i for i, (x, y) in enumerate(zip(_class_keys(w), asked, strict=True)) if x == y]
            rows = [np.unique(runs[first[i]:first[i + 1]]) for i in ok]
            yield pa.RecordBatch.from_arrays(
                [column(b, "key").take(pa.array(ok, pa.int64())), pa.array([len(r) for r in rows], pa.int64()), pa.array([r.tobytes() for r in rows], pa.binary())],
                names=["key", "n_runs", "runs"])

    ids = wanted.select("rep", "key")
    few = ids.count() <= BROADCAST_ROWS         # of some 50 bytes each
    side = F.broadcast(ids) if few else ids
    both = pick(docs, "doc_id", "text").join(side, F.col("doc_id").eqNullSafe(F.col("rep"))).select("text", "key")
    one = both.mapInArrow(run, "key binary, n_runs long, runs binary").dropDuplicates(["key"])
    return one.join(wanted.select("key", "copies", "sig"), "key")


def compare(keys: list[bytes], side: np.ndarray, copies: np.ndarray, sig: np.ndarray, runs: list[np.ndarray],
            band: int, threshold: float, least: dict[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links inside one unit.  side: 0 and 1 for the two blocks of a pair of
    blocks, only pairs across which count; all 2 for a block by itself.  Returns
    per member: linked documents, linked texts, and the root of its tree."""
    m = len(keys)
    bands = band_keys(sig)
    docs, texts, root = np.zeros(m), np.zeros(m), np.arange(m)
    here = int(np.flatnonzero((bands == band).any(0))[0])
    for lo in range(0, m, 256):
        hi = min(m, lo + 256)
        live = np.arange(lo, hi)[:, None] < np.arange(m)[None, :]
        if side[0] != 2:
            live &= side[lo:hi, None] != side[None, :]
        # the pair belongs to the smallest key among the bands it shares
        for b in range(BANDS):
            if b != here:
                live &= ~((bands[lo:hi, b][:, None] == bands[:, b][None, :]) & (bands[lo:hi, b] < band)[:, None])
        i, j = np.nonzero(live)
        i += lo
        matched = np.zeros(len(i), dtype=np.int16)
        for n, fewest in sorted(least.items()):
            for at in range(n - STEP, n):
                matched += sig[i, at] == sig[j, at]
            stay = matched >= fewest
            i, j, matched = i[stay], j[stay], matched[stay]
        if not len(i):
            continue
        both = _common(runs, i, j)
        size = np.fromiter(map(len, runs), dtype=np.int64, count=m)
        # J >= t in whole numbers, t being thousandths
        t = round(threshold * 1000)
        linked = both * 1000 >= t * (size[i] + size[j] - both)
        i, j = i[linked], j[linked]
        np.add.at(docs, i, copies[j])
        np.add.at(docs, j, copies[i])
        np.add.at(texts, i, 1)
        np.add.at(texts, j, 1)
        _union(root, i, j)
    return docs, texts, _roots(root)


def _common(runs: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the given pairs, exactly."""
    if len(i) <= 64:
        return np.array([len(np.intersect1d(runs[a], runs[b], assume_unique=True)) for a, b in zip(i, j, strict=True)], dtype=np.int64)
    used = np.unique(np.concatenate([i, j]))
    place = np.full(int(used.max()) + 1, -1)
    place[used] = np.arange(len(used))
    values = np.concatenate([runs[k] for k in used])
    owner = np.repeat(np.arange(len(used)), [len(runs[k]) for k in used])
    names, number, count = np.unique(values, return_inverse=True, return_counts=True)
    rows = np.unique(place[i])
    where = np.full(len(used), -1)
    where[rows] = np.arange(len(rows))
    total = np.zeros((len(rows), len(used)), dtype=np.float32)
    shared = np.flatnonzero(count > 1)              # runs of one member are in no intersection
    code = np.full(len(names), -1)
    code[shared] = np.arange(len(shared))
    c = code[number]
    order = np.argsort(c, kind="stable")
    c, owner = c[order], owner[order]
    for lo in range(0, len(shared), 4096):          # counts stay far below 2 ** 24
        a, b = np.searchsorted(c, [lo, lo + 4096])
        x = np.zeros((len(used), min(4096, len(shared) - lo)), dtype=np.float32)
        x[owner[a:b], c[a:b] - lo] = 1
        total += x[rows] @ x.T
    return total[where[place[i]], place[j]].astype(np.int64)


def _union(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the trees of the pairs' ends; roots are the smallest positions."""
    while len(i):
        a, b = _roots(root)[i], _roots(root)[j]
        lo, hi = np.minimum(a, b), np.maximum(a, b)
        apart = lo != hi
        if not apart.any():
            return
        np.minimum.at(root, hi[apart], lo[apart])
        i, j = i[apart], j[apart]


def _roots(root: np.ndarray) -> np.ndarray:
    while True:
        up = root[root]
        if (up == root).all():
            return root
        root[:] = up


def _units(batches: Iterator[pa.RecordBatch]):
    """Rows of one unit at a time; a partition holds whole units, in order."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        u = np.stack([np.asarray(column(b, c)) for c in ("band", "bi", "bj")], axis=1)
        cut = np.flatnonzero((u[1:] != u[:-1]).any(1)) + 1
        for lo, hi in zip([0, *cut], [*cut, len(u)], strict=True):
            this = tuple(u[lo])
            if held and this != last:
                yield last, pa.Table.from_batches(held)
                held = []
            held.append(b.slice(lo, hi - lo))
            last = this
    if held:
        yield last, pa.Table.from_batches(held)


def links(docs: DataFrame, classes: DataFrame, n: int, threshold: float, tolerance: float) -> DataFrame:
    """key, root, n_docs, n_texts: for each class that has links found in a unit,
    their number, and the root of its tree there."""
    bands = _bands(classes)
    groups = bands.groupBy("band").agg(F.count(F.lit(1)).alias("m"), F.sum(F.xxhash64("key").cast("decimal(38,0)")).alias("s"),
                                       F.bit_xor(F.xxhash64("key", F.lit(1))).alias("x")).where("m > 1")
    # groups with the same members are compared once, under the smallest key
    groups = written(groups.groupBy("m", "s", "x").agg(F.min("band").alias("band")).select("band", "m"), "groups")
    members = written(bands.join(groups, "band"), "members")
    wanted = written(classes.join(members.select("key").distinct(), "key", "left_semi").select("key", "rep", "copies", "sig"), "wanted")
    sets = written(_sets(docs, wanted, n), "sets")
    sized = members.join(sets.select("key", "n_runs"), "key")
    load = sized.groupBy("band").agg(F.sum("n_runs").alias("load"))
    parts = F.greatest(F.ceil(F.col("m") / UNIT), F.ceil(F.col("load") / UNIT_RUNS)).cast("int")
    placed = members.join(load, "band").withColumn("parts", F.greatest(parts, F.lit(1))).withColumn("b", F.pmod(F.xxhash64("key", F.lit(2)), F.col("parts")).cast("int"))
    units = placed.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "band", "key", "b", F.least("b", "o").alias("bi"), F.greatest("b", "o").alias("bj"))
    spark = docs.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = (units.join(sets, "key").select("band", "bi", "bj", "b", "key", "copies", "sig", "runs")
             .repartition(width, "band", "bi", "bj").sortWithinPartitions("band", "bi", "bj"))
    least = fewest_matches(threshold, tolerance)

    def run(batches):
        for (band, bi, bj), t in _units(blocks(batches, "runs", 8 << 20)):
            if t.num_rows < 2:
                continue
            t = t.sort_by("key")                   # so that roots are smallest keys
            keys = t.column("key").to_pylist()
            b = np.asarray(t.column("b"))
            side = np.full(len(keys), 2) if bi == bj else (b == bj).astype(int)
            sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), dtype=np.uint32).reshape(-1, HASHES)
            runs = [np.frombuffer(x, dtype=np.uint64) for x in t.column("runs").to_pylist()]
            got, texts, root = compare(keys, side, np.asarray(t.column("copies")), sig, runs, int(band), threshold, least)
            some = np.flatnonzero(texts > 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array([keys[i] for i in some], pa.binary()), pa.array([keys[root[i]] for i in some], pa.binary()),
                 pa.array(got[some].astype(np.int64)), pa.array(texts[some].astype(np.int64))], names=["key", "root", "n_docs", "n_texts"])

    return written(dealt.mapInArrow(run, "key binary, root binary, n_docs long, n_texts long"), "links")


def components(edges: DataFrame) -> DataFrame:
    """(u, label) of all ends of the edges (u, v), label being the smallest end of
    the component.  Edges point from the larger end to the smaller; large-star
    moves each to the smallest neighbour of its smaller end, small-star gathers a
    node's smaller neighbours at the smallest of them.  A component's smallest
    node, which all others end up at, has no smaller neighbour and so is in no
    group; the look-up of neighbours is a join of two tables, whose hot keys Spark
    splits.  Each round's tables are written to the shared folder."""
    edges = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    if edges.isEmpty():
        return edges.select("u", F.col("v").alias("label"))
    before = None
    while True:
        low = written(edges.groupBy("u").agg(F.min("v").alias("m")), "low")
        large = edges.join(low.select(F.col("u").alias("v"), "m"), "v", "left").select("u", F.coalesce("m", "v").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        edges = written(small, "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    # a star for each component: every end but the smallest has one edge to it
    return edges.select("u", F.col("v").alias("label")).unionByName(edges.select(F.col("v").alias("u"), F.col("v").alias("label")).distinct())


def join(docs: DataFrame, threshold: float = 0.8, n: int = 5, tolerance: float = 1e-8) -> DataFrame:
    """One row per document: doc_id, class_id (smallest doc_id of the documents it
    is linked to directly or through others, its own if it has no link), n_links
    (other documents whose similarity reaches the threshold, copies among them),
    copy_id (smallest doc_id with the same words) and n_copies (documents with
    the same words, itself among them)."""
    rows, about = _classes(docs, threshold, n, tolerance)
    smallest = about.groupBy("label").agg(F.min("rep").alias("class_id"))
    named = about.join(smallest, "label")
    out = rows.select("doc_id", "key").join(named, "key", "left")
    return out.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"),
                      (F.coalesce("n_docs", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).alias("n_links"),
                      F.coalesce("rep", "doc_id").alias("copy_id"), F.coalesce("copies", F.lit(1)).cast("long").alias("n_copies"))


def _classes(docs: DataFrame, threshold: float, n: int, tolerance: float, places: bool = False) -> tuple[DataFrame, DataFrame]:
    """doc_id, key, sig (and place) of every row; key, rep, copies, n_docs and label (the
    smallest key of the linked classes) of every class."""
    rows = written(sketch(docs, n, places), "sketch")
    have = rows.where("key IS NOT NULL")
    classes = written(have.groupBy("key").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.min("sig").alias("sig")), "classes")
    found = links(docs, classes, n, threshold, tolerance)
    linked = found.groupBy("key").agg(F.sum("n_docs").alias("n_docs"))
    labels = components(found.select(F.col("key").alias("u"), F.col("root").alias("v"))).select(F.col("u").alias("key"), "label")
    about = classes.select("key", "rep", "copies").join(linked, "key", "left").join(labels, "key", "left")
    about = written(about.select("key", "rep", "copies", F.coalesce("n_docs", F.lit(0)).alias("n_docs"), F.coalesce("label", "key").alias("label")), "about")
    return rows, about


def keep_one(docs: DataFrame, threshold: float = 0.8, n: int = 5, tolerance: float = 1e-8) -> DataFrame:
    """One row of each group of linked texts; same columns.  The smallest doc_id
    of the group stays, a null one only where the group has no other; rows are
    judged by doc_id and words, so where a doc_id occurs with two texts each is
    kept or dropped with its own group.  Of repeated rows of the kept document one
    stays.  Texts without words are in no group: only repeated rows with a doc_id
    go, all with a null doc_id stay.

    What goes is decided on narrow rows and written as a list of positions for each
    file of the table; the texts are read once more and never shuffled."""
    docs = rows_.on_files(docs)
    rows, about = _classes(docs, threshold, n, tolerance, places=True)
    best = about.groupBy("label").agg(F.min(F.struct(F.col("rep").isNull().alias("no_id"), "rep", "key")).alias("best"))
    named = about.join(best, "label").select("key", F.col("best.rep").alias("best_id"), F.col("best.key").alias("best_key"))
    narrow = rows.select("file", "at", "doc_id", "key", "said").join(named, "key", "left")
    other = F.col("key").isNotNull() & ~(F.col("doc_id").eqNullSafe(F.col("best_id")) & (F.col("key") == F.col("best_key")))
    gone = narrow.where(other).select("file", "at")
    # rows of one document: of an id with words, or with one text without; a document
    # that is repeated often leaves each task as one row
    left = narrow.where(~other & (F.col("key").isNotNull() | F.col("doc_id").isNotNull()))
    same = ["doc_id", "key", F.when(F.col("key").isNull(), F.col("said")).alias("wordless")]
    left = written(left.select("file", "at", "said", *same), "left")
    order = F.struct("said", "file", "at")
    first = left.groupBy("doc_id", "key", "wordless").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("rows")).where("rows > 1")
    first = first.select(F.col("doc_id").alias("d"), F.col("key").alias("k"), F.col("wordless").alias("w"), "first")
    twice = left.join(first, F.col("doc_id").eqNullSafe(F.col("d")) & F.col("key").eqNullSafe(F.col("k")) & F.col("wordless").eqNullSafe(F.col("w")))
    gone = gone.unionByName(twice.where(order != F.col("first")).select("file", "at"))
    return rows_.apply_marks(docs, rows_.write_marks(gone), rows_.drop)


def query(docs: DataFrame) -> DataFrame:
    return join(docs)
