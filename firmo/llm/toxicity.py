"""Toxicity by multiple-instance learning.

A document is a bag of sentences.  Sentence s has the probability
p_s = sigmoid(b + sum of the weights of its features); the document is toxic
with noisy-or, 1 - prod(1 - p_s).  Only documents are labelled; the gradient of
the noisy-or likelihood tells which sentences are to blame, and the same
weights then locate offending sentences.

Features of a word are its own hash and those of its 3 to 6 byte prefixes.
Scores depend on the text alone.

Edge cases: a null text is empty; a text without words has no sentence and
scores 0.0; repeated rows each get their row; extra columns are ignored; an
empty table gives an empty table; with no labelled rows of both classes every
score is that of the untrained bias."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from firmo.llm.common import Words, blocks, column, find_sorted, labelled_sample, pick, remainder, utf8

PREFIXES = (3, 4, 5, 6)
BREAKS = np.isin(np.arange(256), list(b".!?\n\0"))


@dataclass
class Model:
    table: np.ndarray   # sorted feature hashes
    weight: np.ndarray
    bias: float


def _features(w: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word index, feature hash) for whole words, then for each prefix length."""
    n = w.ends - w.starts
    yield np.arange(len(n)), w.hashes()
    for k in PREFIXES:
        long = np.flatnonzero(n > k)
        s = w.starts[long]
        yield long, w.span_hash(s, s + k) ^ np.uint64(k)


def _sentences(w: Words) -> np.ndarray:
    """Number of the sentence of each word over the block; no sentence spans two texts."""
    raw = np.frombuffer(w.raw, dtype=np.uint8)
    sent = np.cumsum(BREAKS[raw])[w.starts]
    if len(sent) == 0:
        return sent
    new = np.concatenate([[0], (np.diff(sent) != 0) | (np.diff(w.doc) != 0)])
    return np.cumsum(new)


def _softplus(z):
    return np.maximum(z, 0) + np.log1p(np.exp(-np.abs(z)))


def fit(sample: list[tuple[bytes, int]], features: int = 4096, min_docs: int = 4,
        steps: int = 400) -> Model:
    """Train on (text, label) pairs: features that stand out in either class are
    kept, then full-batch Adam on the noisy-or likelihood."""
    y = np.array([t for _, t in sample], dtype=np.float64)
    if len(y) == 0 or y.min() == y.max():
        return Model(np.zeros(0, np.uint64), np.zeros(0), -8.0)
    step = 128
    # documents (all, toxic) that hold each feature, merged block by block
    names, n, pos = np.zeros(0, np.uint64), np.zeros(0), np.zeros(0)
    for at in range(0, len(sample), step):
        w = Words([x for x, _ in sample[at:at + step]])
        doc = w.doc
        for idx, h in _features(w):
            f, d = _unique_pairs(h, doc[idx])
            f, inv = np.unique(np.concatenate([names, f]), return_inverse=True)
            more = inv[len(names):]
            n = np.bincount(inv[:len(names)], n, len(f)) + np.bincount(more, minlength=len(f))
            pos = np.bincount(inv[:len(names)], pos, len(f)) + np.bincount(more, y[d + at], len(f))
            names = f
    rate = y.mean()
    z = (pos - n * rate) / np.sqrt(n * rate * (1 - rate) + 1)
    z[n < min_docs] = 0
    best = np.argsort(-np.abs(z), kind="stable")[:features]
    table = np.sort(names[best[np.abs(z[best]) > 2.0]])
    del names, n, pos, z
    # sentences that hold a kept feature; the others share the bias alone
    sent_of, feat_of, doc_of, empties, base = [], [], [], np.zeros(len(sample)), 0
    for at in range(0, len(sample), step):
        w = Words([x for x, _ in sample[at:at + step]])
        sent, doc = _sentences(w), w.doc
        if len(sent) == 0:
            continue
        empties[at:at + len(w.counts)] += np.bincount(doc[np.flatnonzero(np.diff(sent, prepend=-1))], minlength=len(w.counts))
        for idx, hh in _features(w):
            p = find_sorted(table, hh)
            hit = np.flatnonzero(p >= 0)
            sent_of.append(sent[idx[hit]] + base)
            feat_of.append(p[hit])
            doc_of.append(doc[idx[hit]] + at)
        base += int(sent[-1]) + 1
    if not sent_of:
        return Model(np.zeros(0, np.uint64), np.zeros(0), -8.0)
    raw, feat, doc = map(np.concatenate, (sent_of, feat_of, doc_of))
    ids, sent = np.unique(raw, return_inverse=True)
    sent_doc = np.zeros(len(ids), dtype=np.int64)
    sent_doc[sent] = doc
    empties -= np.bincount(sent_doc, minlength=len(sample))
    theta = np.zeros(len(table) + 1)
    theta[-1] = -6.0
    m = np.zeros_like(theta)
    v = np.zeros_like(theta)
    for t in range(1, steps + 1):
        b = theta[-1]
        zs = b + np.bincount(sent, weights=theta[feat], minlength=len(ids))
        lam = empties * _softplus(b) + np.bincount(sent_doc, weights=_softplus(zs), minlength=len(sample))
        prob = np.clip(-np.expm1(-lam), 1e-9, 1.0)
        slack = 1 - y / prob                       # dNLL/dlambda
        ds = slack[sent_doc] / (1 + np.exp(-np.clip(zs, -30, 30)))
        g = np.empty_like(theta)
        g[:-1] = np.bincount(feat, weights=ds[sent], minlength=len(table))
        g[-1] = ds.sum() + (slack * empties).sum() / (1 + np.exp(-b))
        g = np.clip(g / len(sample), -1, 1) + 1e-5 * np.concatenate([theta[:-1], [0]])
        m = 0.9 * m + 0.1 * g
        v = 0.99 * v + 0.01 * g * g
        theta -= 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
        theta[-1] = min(theta[-1], -2.0)
    return Model(table, theta[:-1].copy(), float(theta[-1]))


def _unique_pairs(h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (np.diff(doc) != 0) | (h[1:] != h[:-1])
    return h[new], doc[new]


def train(docs: DataFrame, labels: DataFrame, divisor: int = 5, held_out: int = 0,
          rows: int = 8000, max_bytes: int = 16 << 20) -> Model:
    """Fit on a bounded sample of labelled rows outside the held-out remainder
    (``rows`` documents and ``max_bytes`` of text at most)."""
    got = labelled_sample(docs, labels, "toxic", divisor, held_out, rows, max_bytes)
    return fit([(r["text"].encode(), r["y"]) for r in got.orderBy("doc_id").toLocalIterator()])


def _sentence_scores(w: Words, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """z of each sentence, its text, and the sentence of each word."""
    sent, doc = _sentences(w), w.doc
    n = int(sent[-1]) + 1 if len(sent) else 0
    z = np.full(n, model.bias)
    for idx, h in _features(w):
        p = find_sorted(model.table, h)
        hit = np.flatnonzero(p >= 0)
        z += np.bincount(sent[idx[hit]], weights=model.weight[p[hit]], minlength=n)
    owner = np.zeros(n, dtype=np.int64)
    owner[sent] = doc
    return z, owner, sent


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, ``keep`` columns, score, n_sentences, n_offending) of every whole text.  No shuffle."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)     # at most ``features`` weights
    names = [id_col, *(k for k in keep if k not in (id_col,))]

    def run(batches):
        m = shared.value
        for b in blocks(batches, text_col):
            w = Words(utf8(column(b, text_col)))
            z, owner, _ = _sentence_scores(w, m)
            n = b.num_rows
            lam = np.bincount(owner, weights=_softplus(z), minlength=n)
            yield pa.RecordBatch.from_arrays(
                [column(b, c) for c in names]
                + [pa.array(-np.expm1(-lam)), pa.array(np.bincount(owner, minlength=n).astype(np.int64)),
                   pa.array(np.bincount(owner, weights=z >= 0, minlength=n).astype(np.int64))],
                names=[*names, "score", "n_sentences", "n_offending"])

    need = pick(docs, *dict.fromkeys([*names, text_col]))
    kinds = dict(need.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in names) + ", score double, n_sentences long, n_offending long"
    return need.mapInArrow(run, schema)


def keep_clean(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows whose score stays below the threshold; same columns.  No shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in blocks(batches, "text"):
            z, owner, _ = _sentence_scores(Words(utf8(column(b, "text"))), shared.value)
            lam = np.bincount(owner, weights=_softplus(z), minlength=b.num_rows)
            yield b.filter(pa.array(-np.expm1(-lam) < threshold))

    return docs.mapInArrow(run, ", ".join(f"`{c}` {t}" for c, t in docs.dtypes))


def locate(docs: DataFrame, model: Model, threshold: float = 0.5, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """The offending sentences: (id, byte_start, byte_end, sentence, score), one
    row for each sentence whose own probability reaches the threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    least = float(np.log(threshold / (1 - threshold)))

    def run(batches):
        for b in blocks(batches, text_col):
            texts = utf8(column(b, text_col))
            w = Words(texts)
            z, owner, sent = _sentence_scores(w, shared.value)
            bad = np.flatnonzero(z >= least)
            lo = w.starts[np.searchsorted(sent, bad, side="left")]
            hi = w.ends[np.searchsorted(sent, bad, side="right") - 1]
            d = owner[bad]
            yield pa.RecordBatch.from_arrays(
                [column(b, id_col).take(pa.array(d)), pa.array(lo - w.at[d]), pa.array(hi - w.at[d]),
                 pa.array([w.raw[x:y].decode("utf-8", "replace") for x, y in zip(lo, hi, strict=True)], pa.string()),
                 pa.array(1 / (1 + np.exp(-z[bad])))],
                names=[id_col, "byte_start", "byte_end", "sentence", "score"])

    need = pick(docs, id_col, text_col)
    return need.mapInArrow(run, f"`{id_col}` {dict(need.dtypes)[id_col]}, byte_start long, byte_end long, sentence string, score double")


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = train(docs, labels, divisor=5, held_out=0)
    out = score(docs, model)
    return out.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_sentences", "n_offending")
