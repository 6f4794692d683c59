"""Quality classifier: a generalised additive model with pairwise interactions.

Cyclic boosting visits the features in turn; each visit fits a shallow tree on
one binned feature and adds it to that feature's lookup table.  The pairs whose
residuals gain most from a two-way table are then boosted the same way.  A
score is the sigmoid of a sum of table entries: one bin search per feature and
vectorised additions.

Edge cases: a null text is empty; an empty text has all features 0 and gets the
score of those bins; repeated rows each get their row; extra columns are
ignored; with no labelled rows of both classes the score is the label mean, or
0.5 where there are no labels."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from firmo.llm.common import Words, blocks, column, labelled_sample, pick, remainder, utf8

FEATURES = ("words", "word_length", "long_words", "short_words", "upper", "digits", "symbols", "exclaims",
            "stops", "lines", "non_ascii", "distinct_words", "top_word", "repeated_lines", "repeated_pairs",
            "sentence_length")

_BYTE = np.arange(256)
CLASSES = {
    "upper": (_BYTE >= 65) & (_BYTE <= 90),
    "digits": (_BYTE >= 48) & (_BYTE <= 57),
    "symbols": np.isin(_BYTE, list(b"#$%&*@^~|<>{}[]\\=+_`")),
    "exclaims": np.isin(_BYTE, list(b"!?")),
    "stops": np.isin(_BYTE, list(b".,;:")),
    "lines": _BYTE == 10,
    "non_ascii": _BYTE >= 128,
}


def _groups(doc: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each text the number of distinct hashes and the count of the commonest."""
    distinct, top = np.zeros(n), np.zeros(n)
    if len(h):
        order = np.lexsort((h, doc))
        h, doc = h[order], doc[order]
        new = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])]))
        np.maximum.at(top, doc[new], np.diff(np.append(new, len(h))))
        distinct = np.bincount(doc[new], minlength=n).astype(float)
    return distinct, top


def features(texts: list[bytes]) -> np.ndarray:
    """One row of FEATURES for each text."""
    w = Words(texts)
    n = len(texts)
    raw = np.frombuffer(w.raw, dtype=np.uint8)
    size = np.maximum(np.diff(w.at) - 1, 1)
    words = np.maximum(w.counts, 1)
    out = np.zeros((n, len(FEATURES)))

    def put(name, values):
        out[:, FEATURES.index(name)] = values

    length = w.ends - w.starts
    doc = w.doc
    put("words", np.log1p(w.counts))
    put("word_length", np.bincount(doc, weights=length, minlength=n) / words)
    put("long_words", np.bincount(doc, weights=length > 12, minlength=n) / words)
    put("short_words", np.bincount(doc, weights=length <= 3, minlength=n) / words)
    for name, mark in CLASSES.items():
        total = np.concatenate([[0], np.cumsum(mark[raw])])
        got = total[w.at[1:]] - total[w.at[:-1]]
        put(name, got / (words if name in ("exclaims", "stops", "lines", "symbols") else size))
    h = w.hashes()
    distinct, top = _groups(doc, h, n)
    put("distinct_words", distinct / words)
    put("top_word", top / words)
    if len(h) > 1:
        same = np.flatnonzero(doc[1:] == doc[:-1])
        pairs, _ = _groups(doc[same], h[same] * np.uint64(31) + h[same + 1], n)
        put("repeated_pairs", 1 - (pairs + 1) / words)
    cut = np.flatnonzero((raw == 10) | (raw == 0))
    line_doc = np.minimum(np.searchsorted(w.at, cut, side="right") - 1, n - 1)
    begin = np.maximum(np.concatenate([[0], cut[:-1] + 1]), w.at[line_doc])
    real = cut > begin
    lines, line_doc = w.span_hash(begin[real], cut[real]), line_doc[real]
    distinct, _ = _groups(line_doc, lines, n)
    count = np.bincount(line_doc, minlength=n)
    put("repeated_lines", 1 - distinct / np.maximum(count, 1))
    ends = np.concatenate([[0], np.cumsum(np.isin(raw, list(b".!?\n")))])
    put("sentence_length", np.log1p(words / (1 + ends[w.at[1:]] - ends[w.at[:-1]])))
    out[w.counts == 0] = 0
    return out


@dataclass
class Model:
    base: float
    cuts: list[np.ndarray]                      # bin edges of each feature
    tables: list[np.ndarray]                    # one value for each bin
    pairs: list[tuple[int, int]] = field(default_factory=list)
    grids: list[np.ndarray] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(self.cuts)], axis=1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        z = np.full(len(x), self.base)
        for j, t in enumerate(self.tables):
            z += t[b[:, j]]
        for (i, j), g in zip(self.pairs, self.grids, strict=True):
            z += g[b[:, i], b[:, j]]
        return z


def _split(g: np.ndarray, h: np.ndarray, least: float = 4.0, ridge: float = 1.0) -> tuple[float, int]:
    """Best cut of a histogram: gain and the first bin of the right side."""
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = gl ** 2 / (hl + ridge) + gr ** 2 / (hr + ridge) - g.sum() ** 2 / (h.sum() + ridge)
    gain[(hl < least * 0.25) | (hr < least * 0.25)] = 0
    k = int(np.argmax(gain)) if len(gain) else 0
    return (float(gain[k]), k + 1) if len(gain) else (0.0, 0)


def _tree(g: np.ndarray, h: np.ndarray, depth: int = 2, ridge: float = 1.0) -> np.ndarray:
    """A tree of ``depth`` cuts over one histogram as a table of leaf values."""
    gain, k = _split(g, h) if depth and len(g) > 1 else (0.0, 0)
    if gain <= 1e-6:
        return np.full(len(g), -g.sum() / (h.sum() + ridge))
    return np.concatenate([_tree(g[:k], h[:k], depth - 1), _tree(g[k:], h[k:], depth - 1)])


def _grid_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """A two-level tree over two features: one cut of the rows, then one of the
    columns on each side."""
    best, out = 0.0, np.zeros_like(g)
    gain, k = _split(g.sum(1), h.sum(1))
    rows = range(1, g.shape[0], max(1, g.shape[0] // 12))
    for r in {*rows, k} - {0}:
        total, table = 0.0, np.zeros_like(g)
        for s in (slice(0, r), slice(r, None)):
            cg, ch = g[s].sum(0), h[s].sum(0)
            t = _tree(cg, ch, depth=1)
            table[s] = t[None, :]
            total -= float((t * cg).sum())
        if total > best:
            best, out = total, table
    return best, out


def fit(x: np.ndarray, y: np.ndarray, bins: int = 48, rounds: int = 150, rate: float = 0.15,
        n_pairs: int = 4, pair_rounds: int = 40) -> Model:
    """Cyclic boosting of single features, then of the strongest pairs."""
    p = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    base = float(np.log(p / (1 - p)))
    k = x.shape[1]
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) if len(y) else np.zeros(0) for j in range(k)]
    model = Model(base, cuts, [np.zeros(len(c) + 1) for c in cuts])
    if len(y) == 0 or y.min() == y.max():
        return model
    b = model.bins(x)
    z = np.full(len(y), base)

    def grad():
        q = 1 / (1 + np.exp(-z))
        return q - y, np.maximum(q * (1 - q), 1e-6)

    for _ in range(rounds):
        for j in range(k):
            g, h = grad()
            n = len(cuts[j]) + 1
            t = rate * _tree(np.bincount(b[:, j], g, n), np.bincount(b[:, j], h, n))
            model.tables[j] += t
            z += t[b[:, j]]

    def cells(i, j, g):
        shape = (len(cuts[i]) + 1, len(cuts[j]) + 1)
        return np.bincount(b[:, i] * shape[1] + b[:, j], g, shape[0] * shape[1]).reshape(shape)

    g, h = grad()
    gains = sorted(((_grid_tree(cells(i, j, g), cells(i, j, h))[0], i, j) for i in range(k) for j in range(i + 1, k)), reverse=True)
    model.pairs = [(i, j) for _, i, j in gains[:n_pairs]]
    model.grids = [np.zeros((len(cuts[i]) + 1, len(cuts[j]) + 1)) for i, j in model.pairs]
    for _ in range(pair_rounds):
        for q, (i, j) in enumerate(model.pairs):
            g, h = grad()
            t = rate * _grid_tree(cells(i, j, g), cells(i, j, h))[1]
            model.grids[q] += t
            z += t[b[:, i], b[:, j]]
    return model


def feature_rows(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The kept columns and the features of every whole text.  No shuffle."""
    def run(batches):
        for b in blocks(batches, "text"):
            x = features(utf8(column(b, "text")))
            yield pa.RecordBatch.from_arrays([column(b, c) for c in keep] + [pa.array(list(x), pa.list_(pa.float64()))],
                                             names=[*keep, "features"])

    kinds = dict(docs.dtypes)
    return docs.mapInArrow(run, ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", features array<double>")


def train(docs: DataFrame, labels: DataFrame, divisor: int = 3, held_out: int = 1,
          rows: int = 12000, max_bytes: int = 48 << 20) -> Model:
    """Fit on a bounded sample of labelled rows outside the held-out remainder
    (``rows`` documents and ``max_bytes`` of text at most); only feature rows
    reach the driver."""
    sample = feature_rows(labelled_sample(docs, labels, "quality", divisor, held_out, rows, max_bytes), ["doc_id", "y"])
    got = sorted((r["doc_id"], r["y"], r["features"]) for r in sample.collect())
    x = np.array([f for _, _, f in got], dtype=float).reshape(len(got), len(FEATURES))
    return fit(x, np.array([y for _, y, _ in got], dtype=float))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every whole text.  No shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)   # some thousand table entries

    def run(batches):
        for b in blocks(batches, "text"):
            z = shared.value.raw(features(utf8(column(b, "text"))))
            yield pa.RecordBatch.from_arrays([column(b, "doc_id"), pa.array(1 / (1 + np.exp(-np.clip(z, -700, 700))))],
                                             names=["doc_id", "score"])

    need = pick(docs, "doc_id", "text")
    return need.mapInArrow(run, f"doc_id {dict(need.dtypes)['doc_id']}, score double")


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    out = score(docs, train(docs, labels, divisor=3, held_out=1))
    return out.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))
