"""Personal data: exact base patterns and a character BiLSTM with a CRF.

Base spans follow fixed patterns.  The tagger reads characters through a
bidirectional LSTM whose outputs score the tags (outside, begin and inside of
each kind); transitions are those of a linear-chain CRF.  It is trained in
numpy on windows of the corpus whose spans are labelled by the base patterns.

Whole texts are tagged.  Each is cut into overlapping windows; each window scores
its characters, overlapping scores are blended by the distance from the window's
edge, and one Viterbi path over the whole text reconciles them, so a span may run
through any number of windows.  Most characters cannot be tagged by the best path
whatever surrounds them (``open_stretches`` gives the bound); the path is searched
between those only, and is the same.  Spans that touch a base span are dropped;
base spans always stay.

A task holds some 60 bytes for each character of a block of texts, or of one text
that is longer than a block.

Edge cases: a null text is empty and has no spans; texts of any length are read
whole, in linear time; repeated rows each get their row; extra columns are ignored; where the
corpus has no labelled window the tagger adds nothing."""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from firmo.llm.common import blocks, column, pick, utf8
from firmo.llm.decontaminate import with_length

KINDS = ("email", "ip", "card", "phone")
TAGS = 1 + 2 * len(KINDS)           # outside, then begin and inside of each kind
CHARS = 130                         # ASCII, other, padding
WINDOW, STRIDE = 128, 104           # neighbouring windows share 24 characters
BATCH = 768                         # windows read at once: products small enough for one thread
BLOCK = 1 << 20

# fixed values: the base patterns
# (a match of IP starts where a run of digits starts and takes the runs whole, so
# the look-behind and the possessive runs change nothing but the time)
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
TRIGGER = re.compile(r"[0-9@]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str):
    """A match starts where the run of local characters before an ``@`` starts,
    so each ``@`` is tried once."""
    free, at = 0, text.find("@")
    while at >= 0:
        a = at
        while a > free and text[a - 1] in LOCAL:
            a -= 1
        m = DOMAIN.match(text, at + 1) if a < at else None
        if m:
            yield a, m.end()
            free = m.end()
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then start; leftmost and non-overlapping in each kind."""
    out = [(0, a, b) for a, b in _emails(text)]
    for m in IP.finditer(text):
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in (x.lstrip("0") for x in m[0].split("."))):
            out.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    for m in PHONE.finditer(text):
        if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((3, m.start(), m.end()))
    return out


def codes(text: str) -> np.ndarray:
    x = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return np.where(x < 128, x, 128).astype(np.int64)


# -- the tagger -------------------------------------------------------------

def _legal() -> np.ndarray:
    """Score of each step between tags that no text can have: an inside tag
    follows only the begin or inside tag of its kind."""
    t = np.zeros((TAGS, TAGS))
    for k in range(len(KINDS)):
        inside = 2 + 2 * k
        t[:, inside] = -1e4
        t[[inside - 1, inside], inside] = 0
    return t


LEGAL = _legal()
START = np.where(np.isin(np.arange(TAGS), 2 + 2 * np.arange(len(KINDS))), -1e4, 0.0)


def bend(z: np.ndarray) -> np.ndarray:
    """z / (1 + |z|): it bends as tanh does, at a fraction of its time; gates are
    its upper half, 0.5 + 0.5 bend(z)."""
    held = np.abs(z)
    held += 1
    return np.divide(z, held, out=held)


def _slope(gate: np.ndarray) -> np.ndarray:
    """Slope of a gate at its value: 0.5 (1 - |bend|)^2."""
    return 0.5 * (1 - np.abs(2 * gate - 1)) ** 2


@dataclass
class Tagger:
    """Weights: for both directions the input table, recurrence and bias; then
    the output layer and the transitions."""
    w: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, hidden: int, seed: int = 7) -> Tagger:
        r = np.random.default_rng(seed)
        w = {}
        for d in "fb":
            w[f"x{d}"] = r.normal(0, 0.3, (CHARS, 4 * hidden))
            w[f"u{d}"] = r.normal(0, 1 / np.sqrt(hidden), (hidden, 4 * hidden))
            w[f"c{d}"] = np.concatenate([np.zeros(hidden), np.ones(hidden), np.zeros(2 * hidden)])
        w["o"] = r.normal(0, 1 / np.sqrt(2 * hidden), (2 * hidden, TAGS))
        w["ob"] = np.zeros(TAGS)
        w["t"] = np.zeros((TAGS, TAGS))
        return cls({k: v.astype(np.float32) for k, v in w.items()})

    def _run(self, x: np.ndarray, d: str, keep: bool = False):
        """Hidden states [T, B, H] of one direction, in the order of the text."""
        w, u, c0 = self.w[f"x{d}"], self.w[f"u{d}"], self.w[f"c{d}"]
        size = u.shape[0]
        order = range(x.shape[1]) if d == "f" else range(x.shape[1] - 1, -1, -1)
        h = np.zeros((len(x), size), np.float32)
        c = np.zeros_like(h)
        out = np.empty((x.shape[1], len(x), size), np.float32)
        held = []
        for t in order:
            z = bend(w[x[:, t]] + h @ u + c0)
            s = 0.5 + 0.5 * z
            i, f, o = s[:, :size], s[:, size:2 * size], s[:, 3 * size:]
            g = z[:, 2 * size:3 * size]
            before, h0 = c, h
            c = f * c + i * g
            tc = bend(c)
            h = o * tc
            out[t] = h
            if keep:
                held.append((t, i, f, g, o, before, tc, h0))
        return out, held

    def emissions(self, x: np.ndarray) -> np.ndarray:
        """Scores [T, B, TAGS], as those of ``_run`` but in few passes over memory."""
        return self.tag_rows(x).transpose(0, 2, 1)

    def tag_rows(self, x: np.ndarray) -> np.ndarray:
        """The scores as [T, TAGS, B]."""
        e = self._scores(x, "f")
        e += self._scores(x, "b")
        e += self.w["ob"][:, None]
        return e

    def _scores(self, x: np.ndarray, d: str) -> np.ndarray:
        size = self.w[f"u{d}"].shape[0]
        # the three gates first, then the new content, each in rows of its own: one stretch of memory
        rows = np.r_[:2 * size, 3 * size:4 * size, 2 * size:3 * size]
        w = (self.w[f"x{d}"] + self.w[f"c{d}"])[:, rows]
        # a gate is half of 1 + bend(z): the halves of the output gate are in u and o (exact, as powers of two are)
        u = np.ascontiguousarray(0.5 * self.w[f"u{d}"][:, rows].T)
        o = np.ascontiguousarray(0.5 * (self.w["o"][:size] if d == "f" else self.w["o"][size:]).T)
        steps, batch = x.shape[1], len(x)
        columns = np.ascontiguousarray(x.T)
        h, c, held_c = (np.zeros((size, batch), np.float32) for _ in range(3))
        out = np.empty((steps, TAGS, batch), np.float32)
        z, held = np.empty((4 * size, batch), np.float32), np.empty((4 * size, batch), np.float32)
        gates, i, f, og, g = z[:3 * size], z[:size], z[size:2 * size], z[2 * size:3 * size], z[3 * size:]
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            np.matmul(u, h, out=z)
            z += w.take(columns[t], axis=0).T
            np.abs(z, out=held)
            held += 1
            z /= held
            gates += 1
            g *= i
            c *= f
            c += g
            c *= 0.5
            np.abs(c, out=held_c)
            held_c += 1
            np.divide(c, held_c, out=h)
            h *= og
            np.matmul(o, h, out=out[t])
        return out

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of the tags y [B, T], and its gradients."""
        (hf, kf), (hb, kb) = self._run(x, "f", True), self._run(x, "b", True)
        h = np.concatenate([hf, hb], axis=2)
        e = h @ self.w["o"] + self.w["ob"]
        steps, batch = e.shape[:2]
        trans = self.w["t"] + LEGAL
        alpha = np.empty(e.shape)
        beta = np.zeros(e.shape)
        alpha[0] = e[0] + START
        for t in range(1, steps):
            alpha[t] = e[t] + _lse(alpha[t - 1][:, :, None] + trans[None], 1)
        for t in range(steps - 2, -1, -1):
            beta[t] = _lse(trans[None] + (e[t + 1] + beta[t + 1])[:, None, :], 2)
        z = _lse(alpha[-1], 1)
        de = np.exp(alpha + beta - z[None, :, None])
        at = (np.arange(steps)[:, None], np.arange(batch)[None, :], y.T)
        gold = START[y[:, 0]].sum() + e[at].sum() + trans[y[:, :-1], y[:, 1:]].sum()
        de[at] -= 1
        pair = np.exp(alpha[:-1, :, :, None] + trans + (e + beta)[1:, :, None, :] - z[None, :, None, None])
        seen = np.bincount((y[:, :-1] * TAGS + y[:, 1:]).ravel(), minlength=TAGS * TAGS).reshape(TAGS, TAGS)
        g = {"t": pair.sum((0, 1)) - seen}
        de = (de / batch).astype(np.float32)
        g["t"] /= batch
        g["o"] = np.einsum("tbh,tbk->hk", h, de)
        g["ob"] = de.sum((0, 1))
        dh = de @ self.w["o"].T
        size = hf.shape[2]
        for d, held, part in (("f", kf, dh[:, :, :size]), ("b", kb, dh[:, :, size:])):
            u = self.w[f"u{d}"]
            every = np.empty((steps, batch, 4 * size), u.dtype)
            before_h = np.empty((steps, batch, size), u.dtype)
            nh = np.zeros((batch, size), np.float32)
            nc = np.zeros_like(nh)
            for t, i, f, gg, o, before, tc, h0 in reversed(held):
                dh_t = part[t] + nh
                dc = nc + dh_t * o * (1 - np.abs(tc)) ** 2
                dz = np.concatenate([dc * gg * _slope(i), dc * before * _slope(f), dc * i * (1 - np.abs(gg)) ** 2, dh_t * tc * _slope(o)], axis=1)
                every[t], before_h[t] = dz, h0
                nh, nc = dz @ u.T, dc * f
            flat = every.reshape(-1, 4 * size)
            chars = x.T.ravel()
            order = np.argsort(chars, kind="stable")
            have, begin = np.unique(chars[order], return_index=True)
            gx = np.zeros_like(self.w[f"x{d}"])
            gx[have] = np.add.reduceat(flat[order], begin, axis=0)
            g[f"x{d}"], g[f"u{d}"], g[f"c{d}"] = gx, before_h.reshape(-1, size).T @ flat, flat.sum(0)
        return float((z.sum() - gold) / batch), g


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


def fit(windows: list[tuple[str, list[tuple[int, int, int]]]], hidden: int = 8, steps: int = 200, batch: int = 32,
        rate: float = 0.02, seed: int = 11) -> Tagger | None:
    """Train on (window, spans) pairs by Adam; None without any span."""
    if not any(s for _, s in windows):
        return None
    x = np.full((len(windows), WINDOW), 129)
    y = np.zeros((len(windows), WINDOW), dtype=np.int64)
    for r, (text, spans) in enumerate(windows):
        c = codes(text)[:WINDOW]
        x[r, :len(c)] = c
        for kind, a, b in sorted(spans, reverse=True):      # of overlapping spans the first kind stands
            y[r, a:b] = 2 + 2 * kind
            y[r, a] = 1 + 2 * kind
    # an inside tag whose beginning another span covers starts a span itself
    for t in range(WINDOW):
        inside = (y[:, t] > 0) & (y[:, t] % 2 == 0)
        cut = inside if t == 0 else inside & (y[:, t - 1] != y[:, t]) & (y[:, t - 1] != y[:, t] - 1)
        y[cut, t] -= 1
    model = Tagger.fresh(hidden)
    r = np.random.default_rng(seed)
    m = {k: np.zeros(v.shape) for k, v in model.w.items()}
    v = {k: np.zeros(w.shape) for k, w in model.w.items()}
    for s in range(1, steps + 1):
        some = r.integers(0, len(x), batch)
        _, g = model.gradients(x[some], y[some])
        norm = np.sqrt(sum(float((a ** 2).sum()) for a in g.values()))
        for k, w in model.w.items():
            a = g[k] * min(1.0, 5 / (norm + 1e-9))
            m[k] = 0.9 * m[k] + 0.1 * a
            v[k] = 0.99 * v[k] + 0.01 * a * a
            w -= (rate * min(1, 2 - 2 * s / steps) * (m[k] / (1 - 0.9 ** s)) / (np.sqrt(v[k] / (1 - 0.99 ** s)) + 1e-8)).astype(np.float32)
    return model


def _blend() -> np.ndarray:
    t = np.arange(WINDOW)
    return (1.0 + np.minimum(t, WINDOW - 1 - t)).astype(np.float32)


def scores(model: Tagger, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Blended scores [characters, TAGS] of all texts, one after the other, relative
    to the tag outside; and where each text begins."""
    size = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    begin = np.concatenate([[0], np.cumsum(size)])
    every = np.concatenate([codes("".join(texts)).astype(np.uint8), np.full(WINDOW, 129, np.uint8)])
    many = np.where(size > 0, 1 + np.maximum(0, -(-(size - WINDOW) // STRIDE)), 0)
    owner = np.repeat(np.arange(len(texts)), many)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
    at, end = begin[owner] + nth * STRIDE, begin[owner + 1]
    total = np.zeros((begin[-1], TAGS), np.float32)
    share = _blend()
    for lo in range(0, len(owner), BATCH):
        first, stop = at[lo:lo + BATCH], np.minimum(at[lo:lo + BATCH] + WINDOW, end[lo:lo + BATCH])
        place = first[:, None] + np.arange(WINDOW)
        e = model.tag_rows(np.where(place < stop[:, None], every[place], 129))
        e[:, 1:] -= e[:, :1]
        e[:, 1:] *= share[:, None, None]
        e[:, 0] = share[:, None]                 # the weights add up in the place of outside, which is 0
        windows = np.ascontiguousarray(e.transpose(2, 0, 1))
        for q, (a, b) in enumerate(zip(first.tolist(), stop.tolist(), strict=True)):
            total[a:b] += windows[q, :b - a]
    total[:, 1:] /= total[:, :1]
    total[:, 0] = 0
    return total, begin


def open_stretches(e: np.ndarray, trans: np.ndarray) -> list[tuple[int, int]]:
    """Stretches of a text outside of which the best path is surely outside.

    Take the tags of a stretch of a path, outside before and after it, and put outside
    in their place: the path loses at most, for each character, the best sum of a tag's
    score over outside and the dearest step into that tag, and the step out.  If that is
    negative for every stretch through a character, the best path is outside there.
    The greatest sum through a character is that of the prefix sums: the greatest at
    or after it less the smallest before it.  No step leads into the first character,
    and none out of the last."""
    legal = np.where(trans > -1e3, trans, -np.inf).astype(np.float64) - float(trans[0, 0])
    into, out_of = legal[:, 1:].max(0).astype(np.float32), float(legal[1:, 0].max())
    gain = e[:, 1] + into[0]
    for k in range(1, TAGS - 1):            # a pass for each tag: far quicker than a maximum over rows of eight
        np.maximum(gain, e[:, k + 1] + into[k], out=gain)
    gain[0] = (e[0, 1:] + np.maximum(into, 0)).max()
    gain[-1] += max(0.0, -out_of)
    sums = np.concatenate([[0.0], np.cumsum(gain, dtype=np.float64)])
    after = np.maximum.accumulate(sums[:0:-1])[::-1]
    before = np.minimum.accumulate(sums[:-1])
    held = np.concatenate([[False], after - before + out_of >= -1e-2, [False]])
    edge = np.flatnonzero(held[1:] != held[:-1])
    return list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


def decode(model: Tagger, texts: list[str]) -> list[list[tuple[int, int, int]]]:
    """(kind, start, end) spans of each text."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not any(texts):
        return out
    every, begin = scores(model, texts)
    trans = (model.w["t"] + LEGAL).astype(np.float32)
    parts, where = [], []
    for r in range(len(texts)):
        e = every[begin[r]:begin[r + 1]]
        for a, b in open_stretches(e, trans) if len(e) else ():
            # the neighbours are outside
            left, right = min(a, 1), min(len(e) - b, 1)
            part = e[a - left:b + right].copy()
            part[:left, 1:] = -1e4
            part[len(part) - right:, 1:] = -1e4
            parts.append(part)
            where.append((r, a - left))
    order = sorted(range(len(parts)), key=lambda q: -len(parts[q]))
    lo = 0
    while lo < len(order):
        hi = min(len(order), lo + max(1, (1 << 21) // len(parts[order[lo]])))
        some = order[lo:hi]
        tags = _viterbi([parts[q] for q in some], trans)
        for q in np.flatnonzero(tags.any(1)).tolist():
            r, a = where[some[q]]
            out[r] += [(k, a + x, a + y) for k, x, y in _spans(tags[q])]
        lo = hi
    return [sorted(spans, key=lambda v: v[1]) for spans in out]


def _viterbi(scores: list[np.ndarray], trans: np.ndarray) -> np.ndarray:
    """Best tags of each text, a row each, outside after its end; the longest first, so that the texts that still run
    are the first rows of each step."""
    n = np.array([len(s) for s in scores])
    steps, batch = int(n[0]), len(scores)
    e = np.zeros((steps, batch, TAGS), np.float32)
    for q, s in enumerate(scores):
        e[:len(s), q] = s
    running = np.searchsorted(-n, -np.arange(steps), side="left")       # texts longer than the step
    best = (e[0] + START).astype(np.float64)
    back = np.zeros((steps, batch, TAGS), np.int8)
    for t in range(1, steps):
        k = running[t]
        step = best[:k, :, None] + trans[None]
        back[t, :k] = step.argmax(1)
        best[:k] = step.max(1) + e[t, :k]
    tag = best.argmax(1)
    tags = np.zeros((batch, steps), np.int8)
    for t in range(steps - 1, -1, -1):
        k = running[t]
        tags[:k, t] = tag[:k]
        tag[:k] = back[t, np.arange(k), tag[:k]]
    return tags


def _spans(tags: np.ndarray) -> list[tuple[int, int, int]]:
    out, free = [], 0
    marked = tags.tolist()
    for a in np.flatnonzero(tags).tolist():
        if a >= free:
            kind = (marked[a] - 1) // 2
            free = a + 1
            while free < len(marked) and marked[free] == 2 + 2 * kind:
                free += 1
            out.append((kind, a, free))
    return out


def find(texts: list[str], model: Tagger | None) -> list[tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]]:
    """(base spans, all spans) of each text."""
    base = [base_spans(t) if TRIGGER.search(t) else [] for t in texts]
    more = decode(model, texts) if model else [[] for _ in texts]
    out = []
    for own, extra in zip(base, more, strict=True):
        taken = sorted((a, b) for _, a, b in own)
        starts = np.array([a for a, _ in taken])
        far = np.maximum.accumulate(np.array([b for _, b in taken])) if taken else starts

        def free(a, b, starts=starts, far=far):
            k = int(np.searchsorted(starts, b)) if len(starts) else 0
            return k == 0 or far[k - 1] <= a

        out.append((own, sorted(own + [s for s in extra if free(s[1], s[2])])))
    return out


def train(docs: DataFrame, rows: int = 3000, windows: int = 3000, per_text: int = 8, plain: int = 3) -> Tagger | None:
    """Fit on windows of a bounded sample, cut as they are in decoding: of at most
    ``rows`` texts that hold a digit or ``@``, by the hash of the id, the first
    ``per_text`` windows with a base span and ``plain`` others by the hash of their
    text; then at most ``windows`` of all.  All four are bounds of the fit alone."""
    sample = (pick(docs, "doc_id", "text").where(F.col("text").rlike("[0-9@]")).select("text", F.xxhash64("doc_id", F.lit(7)).alias("h"))
              .select("h", F.xxhash64("text").alias("th"), "text"))
    ids = sample.select("h", "th").orderBy("h", "th").limit(rows)

    def run(batches):
        for b in blocks(batches, "text"):
            got, spans = [], []
            for raw in utf8(column(b, "text")):
                for part, inside in training_windows(raw.decode(), per_text, plain):
                    got.append(part)
                    spans.append([v for s in inside for v in s])
            yield pa.RecordBatch.from_arrays([pa.array(got, pa.string()), pa.array(spans, pa.list_(pa.int64()))], names=["window", "spans"])

    cut = sample.join(F.broadcast(ids), ["h", "th"]).select("text").mapInArrow(run, "window string, spans array<bigint>")
    few = cut.orderBy(F.size("spans") == 0, F.xxhash64("window"), "window").limit(windows).collect()
    return fit([(r["window"], list(zip(r["spans"][::3], r["spans"][1::3], r["spans"][2::3], strict=True))) for r in few])


def training_windows(text: str, per_text: int, plain: int) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Windows of a text with the parts of base spans inside them."""
    held: dict[int, list[tuple[int, int, int]]] = {}
    last = max(0, -(-(len(text) - WINDOW) // STRIDE))
    for k, x, y in base_spans(text):
        # the windows that a span touches; a long one fills many, of which the first teach enough
        for n in range(max(0, -(-(x + 1 - WINDOW) // STRIDE)), min(last, (y - 1) // STRIDE, x // STRIDE + per_text) + 1):
            at = n * STRIDE
            held.setdefault(n, []).append((k, max(x - at, 0), min(y - at, WINDOW)))
    chosen = sorted(held)[:per_text]
    others = sorted((hashlib.blake2b(text[n * STRIDE:n * STRIDE + WINDOW].encode(), digest_size=8).digest(), n)
                    for n in range(last + 1) if n not in held)[:plain]
    return [(text[n * STRIDE:n * STRIDE + WINDOW], held.get(n, [])) for n in [*chosen, *(n for _, n in others)]]


def _line(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def query(docs: DataFrame) -> DataFrame:
    model = docs.sparkSession.sparkContext.broadcast(train(docs))      # some ten thousand weights
    need = pick(docs, "doc_id", "text")

    def run(batches):
        for b in blocks(batches, "text", BLOCK):
            got = find([t.decode() for t in utf8(column(b, "text"))], model.value)
            counts = [[sum(k == kind for k, _, _ in own) for own, _ in got] for kind in range(len(KINDS))]
            yield pa.RecordBatch.from_arrays(
                [column(b, "doc_id"), *(pa.array(c, pa.int64()) for c in counts),
                 pa.array([hashlib.sha256(_line(own).encode()).hexdigest() for own, _ in got], pa.string()),
                 pa.array([_line(every) for _, every in got], pa.string())],
                names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    return need.mapInArrow(run, f"doc_id {dict(need.dtypes)['doc_id']}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def redact(docs: DataFrame, model: Tagger | None = None) -> DataFrame:
    """The same columns with every span replaced by its kind in brackets; of
    overlapping spans the first names the replacement.  n_chars, where there is
    one, follows the new text; a null text stays null."""
    shared = docs.sparkSession.sparkContext.broadcast(model or train(docs))

    def run(batches):
        for b in blocks(batches, "text", BLOCK):
            texts = column(b, "text").to_pylist()
            for i, (_, spans) in enumerate(find([t or "" for t in texts], shared.value)):
                if spans:
                    out, at = [], 0
                    for a, e, k in sorted((a, e, k) for k, a, e in spans):
                        if a >= at:
                            out += [texts[i][at:a], f"[{KINDS[k].upper()}]"]
                        at = max(at, e)
                    texts[i] = "".join([*out, texts[i][at:]])
            new = pa.array(texts, column(b, "text").type)
            yield pa.RecordBatch.from_arrays([new if c == "text" else column(b, c) for c in b.schema.names], names=b.schema.names)

    out = docs.mapInArrow(run, ", ".join(f"`{c}` {t}" for c, t in docs.dtypes))
    return with_length(out, docs)
