"""Benchmark decontamination with a generalised suffix automaton.

The automaton holds every run of words of the test items.  Training words are
streamed through it; the state and matching length at a word tell which windows
of test items end there.  A window is ``window`` consecutive words of an item,
or the whole item where it is shorter.

Words that occur in no item, and neighbours that stand next to each other in no
item, reset the automaton; whole blocks of text are mapped to word numbers at
once, and only stretches that stay inside the item vocabulary and its word
pairs, long enough for the shortest window, are walked.

The items are dealt by hash to shards of bounded size.  Tasks build a shard's
automaton, write it to the shared folder and report the hashes of its windows;
a bit table of bounded size over these drops nearly all of the documents' words
in one pass.  What is left, stretches of windows that may be an item's, is joined
by window hash with the shards that hold the window, and each shard's rows, in
parts where there are many, are walked through its automaton.  The spans of all
shards are gathered for each document.  Only counts reach the driver.

Edge cases: null and empty texts have no words and are clean; items without
words match nothing; repeated items count once for each item_id; rows with a
null item_id take no part; repeated documents each get their row; extra columns
are ignored; an empty benchmark leaves all documents clean."""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, functions as F

from firmo.llm import files, rows as rows_
from firmo.llm.common import Words, blocks, column, find_sorted, free_name, mix, pick, shared_dir, utf8, written

SHARD_WORDS = 200_000
PROBES, MOST_BITS = 4, 27       # of the bit table: 16 MB at most; fuller, it only drops less
PART_ROWS = 4096                # stretches that one part of a shard walks
STRETCHES = "array<struct<at:bigint,words:binary,keys:array<bigint>>>"
_STRETCHES = pa.list_(pa.struct([("at", pa.int64()), ("words", pa.binary()), ("keys", pa.list_(pa.int64()))]))


@dataclass
class Automaton:
    """Generalised suffix automaton over word numbers, with what its states
    report: items whose full window, or whole short text, ends there."""
    vocab: np.ndarray                       # sorted word hashes
    pairs: np.ndarray                       # sorted codes of neighbouring words
    shortest: int
    window: int
    go: list[dict[int, int]]
    link: list[int]
    length: list[int]
    full: dict[int, list[int]]              # state -> items with its window
    short: dict[int, list[tuple[int, list[int]]]]   # state -> (length, items)
    items: list[str]

    def walk(self, words: list[int]):
        """(last word, window length, items) of each window found in the words."""
        go, link, length = self.go, self.link, self.length
        state = matched = 0
        for i, w in enumerate(words):
            while state and w not in go[state]:
                state = link[state]
                matched = length[state]
            if w in go[state]:
                state = go[state][w]
                matched += 1
            v = state
            while v:
                top = min(matched, length[v])
                if top >= self.window and length[link[v]] < self.window and v in self.full:
                    yield i, self.window, self.full[v]
                for k, items in self.short.get(v, ()):
                    if k <= top:
                        yield i, k, items
                v = link[v]


def build(items: list[tuple[str, bytes]], window: int = 13) -> Automaton | None:
    """The automaton of (item id, text) pairs; None if no item has words."""
    w = Words([t for _, t in items])
    vocab, number = np.unique(w.hashes(), return_inverse=True)
    lists = [number[a:b].tolist() for a, b in zip(w.first[:-1], w.first[1:], strict=True)]
    if not len(vocab):
        return None
    codes = np.unique(np.concatenate([np.array([a * len(vocab) + b for a, b in zip(x, x[1:])], dtype=np.int64) for x in lists] or [np.zeros(0, np.int64)]))
    go: list[dict[int, int]] = [{}]
    link, length = [-1], [0]

    def extend(last: int, c: int) -> int:
        if c in go[last]:
            q = go[last][c]
            return q if length[q] == length[last] + 1 else clone(last, c, q)
        cur = len(go)
        go.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p != -1 and c not in go[p]:
            go[p][c] = cur
            p = link[p]
        if p != -1:
            q = go[p][c]
            link[cur] = q if length[q] == length[p] + 1 else clone(p, c, q)
        return cur

    def clone(p: int, c: int, q: int) -> int:
        new = len(go)
        go.append(dict(go[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        link[q] = new
        while p != -1 and go[p].get(c) == q:
            go[p][c] = new
            p = link[p]
        return new

    for x in lists:
        last = 0
        for c in x:
            last = extend(last, c)
    link[0] = 0
    full: dict[int, list[int]] = {}
    short: dict[int, dict[int, list[int]]] = {}
    for k, x in enumerate(lists):
        state = matched = 0
        for c in x:                            # every prefix is in the automaton
            while state and c not in go[state]:
                state = link[state]
                matched = length[state]
            state, matched = go[state][c], matched + 1
            while length[link[state]] >= window:
                state = link[state]
                matched = length[state]
            if matched >= window:
                matched = min(matched, length[state])
                got = full.setdefault(state, [])
                if not got or got[-1] != k:
                    got.append(k)
        if 0 < len(x) < window:
            while length[link[state]] >= len(x):
                state = link[state]
            short.setdefault(state, {}).setdefault(len(x), []).append(k)
    return Automaton(vocab, codes, min(min(len(x), window) for x in lists if x), window, go, link, length, full,
                     {s: sorted(d.items()) for s, d in short.items()}, [i for i, _ in items])


def hits(auto: Automaton, first: np.ndarray, hashes: np.ndarray):
    """(first word, window length, items) of each window found in texts of hashed
    words; ``first`` are the places where texts begin."""
    number = find_sorted(auto.vocab, hashes)
    n = len(number)
    known = np.flatnonzero(number >= 0)
    if not len(known):
        return
    joined = np.zeros(n + 1, dtype=bool)        # word i stands in a run with word i - 1
    near = known[1:][np.diff(known) == 1]
    code = number[near - 1] * len(auto.vocab) + number[near]
    p = np.minimum(np.searchsorted(auto.pairs, code), max(len(auto.pairs) - 1, 0))
    joined[near] = auto.pairs[p] == code if len(auto.pairs) else False
    joined[first[:-1]] = False
    begin = known[~joined[known]]
    end = known[~joined[known + 1]] + 1
    long = end - begin >= auto.shortest
    for a, b in zip(begin[long].tolist(), end[long].tolist(), strict=True):
        for i, k, items in auto.walk(number[a:b].tolist()):
            yield a + i - k + 1, k, items


def windows(hashes: np.ndarray, first: np.ndarray, sizes: list[int]):
    """(size, first words, window hashes) of all windows of the sizes that lie
    inside one text."""
    n = len(hashes)
    last = np.repeat(first[1:], np.diff(first))
    acc = np.zeros(n, dtype=np.uint64)
    for k in range(1, min(n, max(sizes, default=0)) + 1):
        acc = acc[:n - k + 1] * np.uint64(0xA24BAED4963EE407) + hashes[k - 1:]
        if k in sizes:
            at = np.flatnonzero(np.arange(k, n + 1) <= last[:n - k + 1])
            yield k, at, mix(acc[at] + np.uint64(k))


def _probe(keys: np.ndarray, k: int, bits: int) -> np.ndarray:
    """The k-th place of each key in a table of 2 ** bits bits."""
    return mix(keys + np.uint64(0x9E3779B97F4A7C15 * (k + 1) & (1 << 64) - 1)) & np.uint64((1 << bits) - 1)


def _benchmark(benchmark: DataFrame, window: int, limit: int) -> tuple[DataFrame, str, list[int]]:
    """(key, shard) of all windows of the items, the folder of the shards'
    automata, and the sizes of windows that occur."""
    rows = (pick(benchmark, "item_id", "text").where(F.col("item_id").isNotNull())
            .select(F.col("item_id").cast("string").alias("item"), F.coalesce("text", F.lit("")).alias("text")).distinct())
    most = rows.agg(F.sum(F.floor(F.octet_length("text") / 2) + 1)).first()[0] or 0     # words at most
    shards = max(1, -(-int(most) // limit))
    folder = shared_dir(benchmark.sparkSession, "automata")

    def run(batches):
        def finish(shard, items):
            auto = build(items, window)
            files.put(f"{folder}/{shard}", [pickle.dumps(auto, pickle.HIGHEST_PROTOCOL)])
            w = Words([t for _, t in items])
            size = np.repeat(np.minimum(w.counts, window), w.counts)
            for k, at, keys in windows(w.hashes(), w.first, sorted(set(size.tolist()))):
                own = np.unique(keys[size[at] == k])         # items shorter than the window count whole
                yield pa.RecordBatch.from_arrays([pa.array(own.view(np.int64)), pa.array(np.full(len(own), shard)), pa.array(np.full(len(own), k))], names=["key", "shard", "size"])

        held, last = [], None
        for b in batches:
            for shard, item, text in zip(*(column(b, c).to_pylist() for c in ("shard", "item", "text")), strict=True):
                if held and shard != last:
                    yield from finish(last, held)
                    held = []
                held.append((item, text.encode()))
                last = shard
        if held:
            yield from finish(last, held)

    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("item", "text"), F.lit(shards))).repartition(shards, "shard").sortWithinPartitions("shard", "item", "text")
    table = written(dealt.mapInArrow(run, "key long, shard long, size long"), "windows")
    sizes = sorted(r[0] for r in table.select("size").distinct().collect())     # one number for each length up to the window
    return table.select("key", "shard"), folder, sizes


def _bit_table(table: DataFrame) -> tuple[str, int]:
    """A folder with the words (number, 64 bits) of a bit table over the keys, and
    the logarithm of its size."""
    bits = min(MOST_BITS, max(16, (16 * table.count()).bit_length()))

    def run(batches):
        for b in batches:
            keys = np.asarray(column(b, "key")).view(np.uint64)
            for p in (_probe(keys, k, bits) for k in range(PROBES)):
                yield pa.RecordBatch.from_arrays([pa.array((p >> np.uint64(6)).astype(np.int64)), pa.array((np.uint64(1) << (p & np.uint64(63))).view(np.int64))], names=["at", "word"])

    folder = shared_dir(table.sparkSession, "bits")
    table.select("key").mapInArrow(run, "at long, word long").groupBy("at").agg(F.bit_or("word").alias("word")).repartition(8).write.parquet(folder)
    return folder, bits


_tables: dict[str, np.ndarray] = {}


def _load_bits(folder: str, bits: int) -> np.ndarray:
    """The bit table, read once by each process, which holds one at a time."""
    if folder not in _tables:
        where, path = files._at(folder)
        got = pq.read_table(path, filesystem=where)
        out = np.zeros(1 << bits - 6, dtype=np.uint64)
        out[np.asarray(got.column("at"))] = np.asarray(got.column("word")).view(np.uint64)
        _tables.clear()
        _tables[folder] = out
    return _tables[folder]


def _stretches(w: Words, bits: np.ndarray, log: int, sizes: list[int]) -> dict[int, list[dict]]:
    """For each text the stretches of overlapping windows whose keys are in the
    bit table: place of the first word, hashes of the words, keys."""
    hashes = w.hashes()
    starts, ends, keys = [], [], []
    for k, at, key in windows(hashes, w.first, sizes):
        for i in range(PROBES):
            p = _probe(key, i, log)
            stay = (bits[p >> np.uint64(6)] >> (p & np.uint64(63))) & np.uint64(1) == 1
            at, key = at[stay], key[stay]
        starts.append(at)
        ends.append(at + k)
        keys.append(key)
    out: dict[int, list[dict]] = {}
    start = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    if not len(start):
        return out
    order = np.argsort(start, kind="stable")
    start, end, key = start[order], np.maximum.accumulate(np.concatenate(ends)[order]), np.concatenate(keys)[order].view(np.int64)
    cut = np.concatenate([[0], np.flatnonzero(start[1:] >= end[:-1]) + 1, [len(start)]])
    doc = w.doc
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
        d = int(doc[start[a]])
        out.setdefault(d, []).append({"at": int(start[a] - w.first[d]), "words": hashes[start[a]:end[b - 1]].tobytes(), "keys": np.unique(key[a:b]).tolist()})
    return out


def _walked(stretches: DataFrame, table: DataFrame, folder: str) -> DataFrame:
    """row, spans, items of each document row with hits.  ``stretches`` has row,
    at, words, keys."""
    routes = stretches.select("row", "at", F.explode("keys").alias("key")).join(table, "key").select("row", "at", "shard").distinct()
    routes = written(routes, "routes")
    load = routes.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / PART_ROWS).cast("long").alias("parts"))
    width = int(stretches.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = (routes.join(load, "shard").withColumn("part", F.pmod(F.xxhash64("row", "at"), F.col("parts"))).join(stretches.select("row", "at", "words"), ["row", "at"])
             .repartition(width, "shard", "part").sortWithinPartitions("shard", "part"))

    def run(batches):
        auto, last = None, None
        for b in blocks(batches, "words"):
            shard = np.asarray(column(b, "shard"))
            cut = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(shard)]
            for lo, hi in zip(cut, cut[1:], strict=False):
                if shard[lo] != last:
                    auto, last = pickle.loads(files.read(f"{folder}/{shard[lo]}")), shard[lo]
                part = b.slice(lo, hi - lo)
                words = [np.frombuffer(x, dtype=np.uint64) for x in column(part, "words").to_pylist()]
                first = np.concatenate([[0], np.cumsum([len(x) for x in words])])
                at = np.asarray(column(part, "at")).tolist()
                spans: list[list[tuple[int, int]]] = [[] for _ in words]
                items: list[set[str]] = [set() for _ in words]
                for start, k, names in hits(auto, first, np.concatenate(words)):
                    i = int(np.searchsorted(first, start, side="right")) - 1
                    a = at[i] + start - int(first[i])
                    spans[i].append((a, a + k))
                    items[i].update(auto.items[x] for x in names)
                yield pa.RecordBatch.from_arrays([column(part, "row"), pa.array([_merge(x) for x in spans], pa.list_(pa.int64())), pa.array([list(x) for x in items], pa.list_(pa.string()))], names=["row", "spans", "items"])

    got = dealt.select("shard", "part", "row", "at", "words").mapInArrow(run, "row long, spans array<bigint>, items array<string>").where(F.size("spans") > 0)
    return got.groupBy("row").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))


def mark(docs: DataFrame, benchmark: DataFrame, window: int = 13, shard_words: int = SHARD_WORDS,
         keep: list[str] | None = None) -> tuple[DataFrame, str, str, str]:
    """The documents' columns (or those of ``keep``) and three more, whose names
    come with them: the word spans hit (first and end of each, merged, in one
    array), the sorted ids of occurring items, and the number of words.  Only
    rows with stretches of the items are shuffled."""
    names = [free_name(docs, n) for n in ("hit_spans", "hit_items", "word_count")]
    row, found_name = free_name(docs, "hit_row"), free_name(docs, "hit_stretches")
    kinds = {c: t for c, t in docs.dtypes if keep is None or c in keep}
    table, folder, sizes = _benchmark(benchmark, window, shard_words)
    bits_folder, log = _bit_table(table) if sizes else ("", 0)

    def run(batches):
        bits = _load_bits(bits_folder, log) if sizes else None
        for b in blocks(batches, "text"):
            w = Words(utf8(column(b, "text")))
            got = _stretches(w, bits, log, sizes) if sizes else {}
            yield pa.RecordBatch.from_arrays([*(column(b, c) for c in kinds), pa.array(w.counts.astype(np.int64)), pa.array([got.get(i, []) for i in range(b.num_rows)], _STRETCHES)],
                                             names=[*kinds, names[2], found_name])

    base = docs.mapInArrow(run, ", ".join(f"`{c}` {t}" for c, t in [*kinds.items(), (names[2], "bigint"), (found_name, STRETCHES)]))
    own = [F.col(f"`{c}`") for c in kinds]
    none = [F.expr(f"cast(array() as array<{t}>)").alias(n) for n, t in zip(names, ("bigint", "string"), strict=False)]
    if not sizes:
        return base.select(*own, *none, names[2]), *names
    # row numbers hold only for rows that are written
    base = written(base.withColumn(row, F.monotonically_increasing_id()), "marked")
    some = base.where(F.size(found_name) > 0)
    stretches = some.select(F.col(row).alias("row"), F.explode(found_name).alias("x")).select("row", "x.at", "x.words", "x.keys")
    hit = _walked(stretches, table, folder).select(F.col("row").alias(row), F.col("spans").alias(names[0]), F.col("items").alias(names[1]))
    joined = some.join(hit, row, "left").select(*own, *[F.coalesce(n, e).alias(n) for n, e in zip(names, none, strict=False)], names[2])
    schema = ", ".join(f"`{c}` {t}" for c, t in [*kinds.items(), (names[0], "array<bigint>"), (names[1], "array<string>"), (names[2], "bigint")])
    clean_rows = base.where(F.size(found_name) == 0).select(*own, *none, names[2])
    return clean_rows.unionByName(joined.mapInArrow(_merged(names[0]), schema)), *names


def _merged(spans_name: str):
    """Merge the spans of each row."""
    def run(batches):
        for b in batches:
            spans = [_merge(list(zip(x[::2], x[1::2], strict=True))) for x in column(b, spans_name).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(spans, pa.list_(pa.int64())) if c == spans_name else column(b, c) for c in b.schema.names], names=b.schema.names)
    return run


def _without(raw: bytes, starts: np.ndarray, ends: np.ndarray, spans: list[int]) -> str:
    """The text without the words of the spans."""
    out, at = [], 0
    for x, y in zip(spans[::2], spans[1::2], strict=True):
        out.append(raw[at:starts[x]])
        at = int(ends[y - 1])
    return b"".join([*out, raw[at:]]).decode()


def _merge(spans: list[tuple[int, int]]) -> list[int]:
    out: list[int] = []
    for a, b in sorted(spans):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def _hit_words(spans: str):
    """Words in the merged spans: the sum of the ends less that of the starts."""
    pair = F.transform(F.col(spans), lambda x, i: F.when(i % 2 == 1, x).otherwise(-x))
    return F.aggregate(pair, F.lit(0).cast("long"), lambda a, x: a + x)


def _contaminated(hit, words, share: int = 20):
    """Some word is hit, and at least one in ``share``."""
    return (hit > 0) & (share * hit >= words)


def query(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    got, spans, items, words = mark(pick(docs, "doc_id", "text"), benchmark, keep=["doc_id"])
    got = got.withColumn("n_hit", _hit_words(spans))
    return got.select("doc_id", F.col(words).alias("n_words"), "n_hit", F.size(items).cast("long").alias("n_items"),
                      F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
                      _contaminated(F.col("n_hit"), F.col(words)).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, window: int = 13, share: int = 20) -> DataFrame:
    """Drop documents of which at least one word in ``share`` is hit; cut the hit
    spans out of the others.  Same columns; n_chars, where there is one, follows
    the new text.

    Only rows with stretches of the items are written and shuffled, without their
    texts; what was hit comes back as spans by the row's file and position."""
    table, folder, sizes = _benchmark(benchmark, window, SHARD_WORDS)
    if not sizes:
        return docs
    docs = rows_.on_files(docs)
    bits_folder, log = _bit_table(table)
    whole, file, at = rows_.placed(docs)

    def run(batches):
        bits = _load_bits(bits_folder, log)
        for b in blocks(batches, "text"):
            got = _stretches(Words(utf8(column(b, "text"))), bits, log, sizes)
            some = pa.array(sorted(got), pa.int64())
            yield pa.RecordBatch.from_arrays([column(b, "file").take(some), column(b, "at").take(some), pa.array([got[i] for i in sorted(got)], _STRETCHES)], names=["file", "at", "found"])

    found = whole.select("text", F.col(file).alias("file"), F.col(at).alias("at")).mapInArrow(run, f"file string, at long, found {STRETCHES}")
    # row numbers hold only for rows that are written
    found = written(found.withColumn("row", F.monotonically_increasing_id()), "stretches")
    hit = _walked(found.select("row", F.explode("found").alias("x")).select("row", "x.at", "x.words", "x.keys"), table, folder)
    marks = found.select("row", "file", "at").join(hit.select("row", "spans"), "row").drop("row")
    return with_length(rows_.apply_marks(docs, rows_.write_marks(marks), _cutter(share)), docs)


def _cutter(share: int):
    """Rows with at least one hit word in ``share`` go, from the others the hit spans."""
    def change(batch: pa.RecordBatch, marks: list[dict | None]) -> pa.RecordBatch:
        texts, stay = column(batch, "text").to_pylist(), [True] * len(marks)
        for i, m in enumerate(marks):
            if m is not None:
                spans = _merge(list(zip(m["spans"][::2], m["spans"][1::2], strict=True)))
                raw = (texts[i] or "").encode()
                w = Words([raw])
                hits = sum(spans[1::2]) - sum(spans[::2])
                stay[i] = not (hits > 0 and share * hits >= len(w.starts))
                texts[i] = _without(raw, w.starts, w.ends, spans)
        new = pa.array(texts, column(batch, "text").type)
        out = pa.RecordBatch.from_arrays([new if c == "text" else column(batch, c) for c in batch.schema.names], names=batch.schema.names)
        return out.filter(pa.array(stay))
    return change


def with_length(out: DataFrame, like: DataFrame) -> DataFrame:
    """n_chars recomputed from the text, where the table has that column."""
    if "n_chars" in like.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(dict(like.dtypes)["n_chars"]))
    return out.select(*[F.col(f"`{c}`") for c in like.columns])
