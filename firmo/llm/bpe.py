"""BPE encoding and decoding.

The word's adjacent pairs are the leaves of a segment tree over
(rank, position); its root is the leftmost pair of the lowest rank.  A merge
changes three leaves, each updated along its path to the root, until the root
holds no mergeable pair.  Words of up to 64 bytes run many at a time as rows of
one array (one tree per row); longer ones run alone, in the same steps.

Words that occurred before are looked up in a bounded table.  Strings of
special tokens become their ids, as the library does.

Edge cases: a null or empty text has no tokens and decodes to the empty text;
text of any length is encoded whole; repeated rows each get their row; extra
columns are ignored."""

from __future__ import annotations

import hashlib
import json
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from firmo.llm.common import blocks, column, pick, utf8

NONE = np.int64(1) << np.int64(60)
REMEMBER = 100_000
#: fixed value: the split pattern of the byte-level pre-tokenizer
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same cuts for texts whose characters beyond ASCII are Latin letters and
#: common punctuation, in the plain ``re`` syntax, which is several times faster.
_L = r"A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u024f"
PLAIN = re.compile(rf" ?[{_L}]+| ?[0-9]+|'(?:s|t|re|ve|m|ll|d)| ?[^\s{_L}0-9]+|\s+(?!\S)|\s+")
NOT_PLAIN = re.compile(rf"[^\x00-\x1b\x20-\x7f{_L}\u2010-\u2027]")
SPREAD = np.uint64(0x9E3779B97F4A7C15)
SLOT_BITS = 18


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: printable Latin-1 bytes stand
    for themselves, the others for the characters from U+0100 on, in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class Bpe:
    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        letters = byte_alphabet()
        to_byte = {c: b for b, c in enumerate(letters)}
        self.special = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
        self.bytes_of = [b""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(to_byte[c] for c in token)
        for token, i in self.special.items():
            self.bytes_of[i] = token
        self.first = np.array([vocab[c] for c in letters], dtype=np.int64)
        self.width = np.int64(len(self.bytes_of))
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        key = np.array([vocab[a] * int(self.width) + vocab[b] for a, b in merges], dtype=np.int64)
        self.merged = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)
        self.ranks = dict(zip(key.tolist(), range(len(key)), strict=True))
        slots = ((key.view(np.uint64) * SPREAD) >> np.uint64(64 - SLOT_BITS)).tolist()
        self.slot_key = np.full(1 << SLOT_BITS, -1, dtype=np.int64)
        self.slot_rank = np.full(1 << SLOT_BITS, NONE, dtype=np.int64)
        taken: dict[int, int] = {}
        for rank, slot in enumerate(slots):
            while slot in taken:
                slot = (slot + 1) & ((1 << SLOT_BITS) - 1)
            taken[slot] = rank
        at = np.fromiter(taken.keys(), dtype=np.int64)
        rank = np.fromiter(taken.values(), dtype=np.int64)
        self.slot_key[at], self.slot_rank[at] = key[rank], rank
        self.split = regex.compile(PATTERN)
        self.cut = re.compile(b"|".join(re.escape(t) for t in sorted(self.special, key=len, reverse=True))) if self.special else None
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    # -- one word tree per row ------------------------------------------------
    def pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE where it has none: a hash table with linear probing."""
        k = a * self.width + b
        slot = ((k.view(np.uint64) * SPREAD) >> np.uint64(64 - SLOT_BITS)).view(np.int64)
        there = self.slot_key[slot]
        out = np.where(there == k, self.slot_rank[slot], NONE)
        ask = np.flatnonzero((there != k) & (there >= 0))
        while len(ask):
            slot[ask] = (slot[ask] + 1) & ((1 << SLOT_BITS) - 1)
            there = self.slot_key[slot[ask]]
            hit = there == k[ask]
            out[ask[hit]] = self.slot_rank[slot[ask[hit]]]
            ask = ask[~hit & (there >= 0)]
        return out

    def merge_rows(self, words: list[bytes], size: int) -> list[bytes]:
        """Ids (as little-endian 32-bit) of words of at most ``size`` bytes, size a power of 2."""
        m = len(words)
        n = np.fromiter(map(len, words), dtype=np.int64, count=m)
        place = np.arange(size, dtype=np.int64)
        live = place[None, :] < n[:, None]
        sym = np.zeros((m, size + 1), dtype=np.int64)
        sym[:, :size][live] = self.first[np.frombuffer(b"".join(words), dtype=np.uint8)]
        nxt = np.tile(np.arange(1, size + 2, dtype=np.int64), (m, 1))
        prv = np.tile(np.arange(-1, size, dtype=np.int64), (m, 1))
        tree = np.full((m, 2 * size), NONE, dtype=np.int64)
        pairs = np.flatnonzero(live[:, 1:].ravel())
        row, at = np.divmod(pairs, size - 1)
        rank = self.pair_rank(sym[row, at], sym[row, at + 1])
        tree[row, size + at] = np.where(rank < NONE, rank * size + at, NONE)
        for level in range(size.bit_length() - 2, -1, -1):
            lo = 1 << level
            tree[:, lo:2 * lo] = np.minimum(tree[:, 2 * lo:4 * lo:2], tree[:, 2 * lo + 1:4 * lo:2])
        # flat views: a position of row r is r * width + column
        fs, fn, fp, ft, fl = sym.ravel(), nxt.ravel(), prv.ravel(), tree.ravel(), live.ravel()
        wide, deep = size + 1, 2 * size

        def update(rows, leaf, value):
            root = rows * deep
            node = leaf + size
            ft[root + node] = value
            for _ in range(size.bit_length() - 1):
                node = node >> 1
                child = root + 2 * node
                ft[root + node] = np.minimum(ft[child], ft[child + 1])

        rows = np.flatnonzero(tree[:, 1] < NONE)
        while len(rows):
            best = ft[rows * deep + 1]
            at, rank = best & (size - 1), best >> (size.bit_length() - 1)
            base = rows * wide
            here = base + at
            right = fn[here]
            after = fn[base + right]
            made = self.merged[rank]
            fs[here] = made
            fl[rows * size + right] = False
            fn[here] = after
            fp[base + np.minimum(after, size)] = at
            update(rows, right, NONE)
            new = np.full(len(rows), NONE)
            some = np.flatnonzero(after < n[rows])
            new[some] = self.pair_rank(made[some], fs[base[some] + after[some]])
            update(rows, at, np.where(new < NONE, new * size + at, NONE))
            left = fp[here]
            some = np.flatnonzero(left >= 0)
            if len(some):
                left = left[some]
                new = self.pair_rank(fs[base[some] + left], made[some])
                update(rows[some], left, np.where(new < NONE, new * size + left, NONE))
            rows = rows[ft[rows * deep + 1] < NONE]
        flat = sym[:, :size][live].astype("<u4").tobytes()
        cut = (np.concatenate([[0], np.cumsum(live.sum(1))]) * 4).tolist()
        return [flat[a:b] for a, b in zip(cut, cut[1:])]

    # -- one long word --------------------------------------------------------
    def merge_long(self, word: bytes) -> bytes:
        n = len(word)
        size = 1 << max(1, (n - 1).bit_length())
        sym = self.first[np.frombuffer(word, dtype=np.uint8)].tolist()
        width, ranks, merged, none = int(self.width), self.ranks, self.merged, int(NONE)

        def leaf(i, j):
            r = ranks.get(sym[i] * width + sym[j])
            return none if r is None else r * size + i

        tree = [none] * (2 * size)
        for i in range(n - 1):
            tree[size + i] = leaf(i, i + 1)
        for i in range(size - 1, 0, -1):
            tree[i] = min(tree[2 * i], tree[2 * i + 1])

        def update(i, value):
            i += size
            tree[i] = value
            while i > 1:
                i >>= 1
                a, b = tree[2 * i], tree[2 * i + 1]
                tree[i] = a if a < b else b

        nxt, prv, live = list(range(1, n + 1)), list(range(-1, n - 1)), bytearray(b"\1") * n
        while tree[1] < none:
            rank, i = divmod(tree[1], size)
            j = nxt[i]
            k = nxt[j]
            sym[i] = int(merged[rank])
            live[j] = 0
            nxt[i] = k
            update(j, none)
            if k < n:
                prv[k] = i
                update(i, leaf(i, k))
            else:
                update(i, none)
            if prv[i] >= 0:
                update(prv[i], leaf(prv[i], i))
        return np.array([s for s, x in zip(sym, live, strict=True) if x], dtype="<u4").tobytes()

    # -- texts ----------------------------------------------------------------
    def learn(self, words: set[str]) -> None:
        """Put the ids of these words into the table.  The table has two
        generations, so that it stays bounded and frequent words stay in it."""
        new = words.difference(self.words)
        if len(self.words) + len(new) > REMEMBER:
            self.older, self.words = self.words, {}
            new = words
        have = {w: self.older[w] for w in new if w in self.older}
        self.words.update(have)
        sized: dict[int, list[str]] = {8: [], 16: [], 32: [], 64: []}
        raws: dict[int, list[bytes]] = {8: [], 16: [], 32: [], 64: []}
        for w in new.difference(have):
            raw = w.encode()
            n = len(raw)
            if n > 64:
                self.words[w] = self.merge_long(raw)
            else:
                size = 8 if n <= 8 else 16 if n <= 16 else 32 if n <= 32 else 64
                sized[size].append(w)
                raws[size].append(raw)
        for size, some in sized.items():
            for at in range(0, len(some), 8192):
                self.words.update(zip(some[at:at + 8192], self.merge_rows(raws[size][at:at + 8192], size), strict=True))

    def cuts(self, text: str) -> list[str]:
        return (self.split if NOT_PLAIN.search(text) else PLAIN).findall(text)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers."""
        parts: list[tuple[int, list[str], bytes]] = []     # text, words or else fixed ids
        words: set[str] = set()
        for i, t in enumerate(texts):
            at = 0
            for m in self.cut.finditer(t) if self.cut else ():
                parts += [(i, self.cuts(t[at:m.start()].decode()), b""), (i, [], self.special[m[0]].to_bytes(4, "little"))]
                words.update(parts[-2][1])
                at = m.end()
            found = self.cuts((t[at:] if at else t).decode())
            words.update(found)
            parts.append((i, found, b""))
        self.learn(words)
        get = self.words.__getitem__
        out: list[list[bytes]] = [[] for _ in texts]
        for i, found, fixed in parts:
            out[i].append(b"".join(map(get, found)) if found else fixed)
        return [b"".join(x) for x in out]

    def decode(self, ids: bytes) -> str:
        get = self.bytes_of.__getitem__
        return b"".join(map(get, np.frombuffer(ids, dtype="<u4").tolist())).decode("utf-8", "replace")


_loaded: dict[str, Bpe] = {}


def load(path: str) -> Bpe:
    """The tokenizer of a vocabulary file that every machine has at this path."""
    if path not in _loaded:
        _loaded[path] = Bpe(path)
    return _loaded[path]


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) of every whole text.  No shuffle."""
    need = pick(docs, id_col, text_col)

    def run(batches):
        bpe = load(path)
        for b in blocks(batches, text_col):
            got = bpe.encode(utf8(column(b, text_col)))
            ids = pa.array([np.frombuffer(x, dtype="<u4").astype(np.int32) for x in got], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([column(b, id_col), ids], names=[id_col, "ids"])

    return need.mapInArrow(run, f"`{id_col}` {dict(need.dtypes)[id_col]}, ids array<int>")


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text) from arrays of ids; a null array decodes to the empty text."""
    need = pick(encoded, id_col, ids_col)

    def run(batches):
        bpe = load(path)
        for b in batches:
            texts = [bpe.decode(np.array(x or [], dtype="<u4").tobytes()) for x in column(b, ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([column(b, id_col), pa.array(texts, pa.string())], names=[id_col, "text"])

    return need.mapInArrow(run, f"`{id_col}` {dict(need.dtypes)[id_col]}, text string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Per document: doc_id, n_tokens, and the digests of its ids and of the text decoded from them."""
    need = pick(docs, "doc_id", "text")

    def run(batches):
        bpe = load(path)
        for b in blocks(batches, "text"):
            ids = bpe.encode(utf8(column(b, "text")))
            yield pa.RecordBatch.from_arrays(
                [column(b, "doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64()),
                 pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                 pa.array([hashlib.sha256(bpe.decode(x).encode()).hexdigest() for x in ids], pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return need.mapInArrow(run, f"doc_id {dict(need.dtypes)['doc_id']}, n_tokens long, ids_sha256 string, decoded_sha256 string")
