"""Cross-tokenizer alignment: the tokens of two tokenizers over the same bytes, cut
into groups wherever tokens of both end at one byte.

Tokenizer A is a byte-level BPE (``tokenizers``), B a piece BPE with byte fallback
(``sentencepiece``); both read a space and the text.

Byte-range chunks form a monoid.  A chunk's fragment is an open prefix (the tokens up
to its first common end, as the group may have begun before), closed groups, and an
open suffix (the tokens after its last common end); a chunk without a common end is
open as a whole.  Joining two fragments joins the left suffix and the right prefix,
which may close further groups; it is associative, so fragments of a very long
document are made by many tasks and reduced as a tree, ``FAN`` at a time.  Closed
groups leave the tree at once, as pieces (document, byte offset, groups), so that what
is reduced stays small.  Each side of a chunk starts at the first place after the
range's start where its own tokenizer surely cuts: B between a character and a space,
A also between an ASCII letter and a digit; so the two sides of a range differ.

A text of one range is a whole document.  Inside it the same cut gives the units of a
task's table (unit to tokens, groups, links), as most units repeat.

Counts of linked id pairs cover all documents: tasks add up their own, a partial
aggregate adds those, and the table is read back by the tasks that need it (up to
``TABLE_PAIRS`` pairs, 13 bytes each; a larger one is joined by Spark instead, with
the same result).

Defined results: null and empty texts, and texts that a tokenizer does not keep byte
by byte, have no tokens: zeros and ''.  A null id stays null; repeated rows and equal
ids are rows of their own, in counts too; an empty table gives an empty result;
further columns of any name are left out."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from firmo.llm import files
from firmo.llm.bpe import byte_alphabet
from firmo.llm.common import blocks, column, pick, shared_dir, utf8, written

#: bytes of a range of a long text
CHUNK = 1 << 16
#: fragments that a step of the tree joins
FAN = 8
#: a task's table of units starts anew when it holds so many, or one of so many characters
UNITS, UNIT_BYTES = 300_000, 4096
#: characters of units that go to a tokenizer at once
PART_CHARS = 4096
#: pairs of the table of counts that tasks read as a whole
TABLE_PAIRS = 4_000_000
#: a task's counts of pairs are sent on when it holds so many
HELD_PAIRS = 1_000_000
#: rows of a join with a larger table are dealt by so many salts
SALTS = 16

# a space, and what follows up to the next space after another character
_UNIT = re.compile(r" \s*+\S*+(?:[^\S ]\s*+\S*+)*+")
_LETTER_DIGIT = re.compile(rb"[A-Za-z](?=[0-9])|[0-9](?=[A-Za-z])|[!-~](?= )")

Tokens = tuple[np.ndarray, np.ndarray]      # ids, and the byte offsets where they end


class Pair:
    """The two tokenizers, from files that every machine has."""

    def __init__(self, a_path: str, b_path: str) -> None:
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = SentencePieceProcessor(model_file=b_path)
        of = {c: b for b, c in enumerate(byte_alphabet())}
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.a_bytes[i] = bytes(of[c] for c in token) if all(c in of for c in token) else token.encode()
        self.b_bytes = [bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in ((i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))]
        self.a_size = np.array([len(x) for x in self.a_bytes])
        self.b_size = np.array([len(x) for x in self.b_bytes])
        self.units: Units | None = None
        self.space = [self.b.piece_to_id("▁")]

    def a_ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]

    def b_ids(self, texts: list[str]) -> list[list[int]]:
        """Of texts that start with a space, which sentencepiece adds itself, but for the empty text."""
        return [x or self.space for x in self.b.encode([t[1:] for t in texts], num_threads=1)]

    def same(self, raw: bytes, ids: list[int], of: list[bytes]) -> bool:
        return b"".join([of[i] for i in ids]) == raw


_loaded: dict[tuple[str, str], Pair] = {}


def load(a_path: str, b_path: str) -> Pair:
    if (a_path, b_path) not in _loaded:
        _loaded[a_path, b_path] = Pair(a_path, b_path)
    return _loaded[a_path, b_path]


# -- groups and links of closed tokens -------------------------------------------
def common_ends(a: Tokens, b: Tokens) -> np.ndarray:
    return a[1][np.isin(a[1], b[1], assume_unique=True)] if len(b[1]) else b[1]


def groups_text(a: Tokens, b: Tokens, ends: np.ndarray) -> str:
    """The groups as ``a1,a2|b1;a3|b2,b3``; the last token of each side ends a group."""
    return ";".join(_groups(a, b, ends))


def _groups(a: Tokens, b: Tokens, ends: np.ndarray) -> list[str]:
    a_cut, b_cut = np.searchsorted(a[1], ends, "right"), np.searchsorted(b[1], ends, "right")
    a_ids, b_ids = list(map(str, a[0].tolist())), list(map(str, b[0].tolist()))
    out, i, j = [], 0, 0
    for m, n in zip(a_cut.tolist(), b_cut.tolist(), strict=True):
        out.append((a_ids[i] if m == i + 1 else ",".join(a_ids[i:m])) + "|" + (b_ids[j] if n == j + 1 else ",".join(b_ids[j:n])))
        i, j = m, n
    return out


def links(a: Tokens, b: Tokens) -> np.ndarray:
    """(A id << 16 | B id) of all overlapping tokens: between two neighbouring ends of
    either side lies one overlap, of one token of each."""
    ends = np.union1d(a[1], b[1])
    return ((a[0][np.searchsorted(a[1], ends)].astype(np.uint32) << np.uint32(16))
            | b[0][np.searchsorted(b[1], ends)].astype(np.uint32))


class Units:
    """A table of units: number, groups text, counts and links of each."""

    def __init__(self, pair: Pair) -> None:
        self.pair = pair
        self.clear()

    def clear(self) -> None:
        self.of: dict[str, int] = {}
        self.text: list[str] = []
        self.numbers = np.empty((0, 4), np.int64)       # n_a, n_b, n_groups (0: bytes differ), n_links
        self.links = np.empty(0, np.uint32)             # of all units, one after the other

    def tokens_of(self, new: list[str]) -> tuple[list[str], list[int], list[int], list[str]]:
        """Units whose bytes both tokenizers keep, their A ids and B ids one after the
        other, and the units whose bytes differ.  Units go to the tokenizers many at a
        time, as both cut between them; one that ends in white space goes alone."""
        p, parts, open_ = self.pair, [], []
        size = 0
        for u in new:
            if u[-1].isspace():
                parts.append([u])
                continue
            open_.append(u)
            size += len(u)
            if size > PART_CHARS:
                parts.append(open_)
                open_, size = [], 0
        if open_:
            parts.append(open_)
        kept: list[str] = []
        ids_a: list[int] = []
        ids_b: list[int] = []
        bad: list[str] = []
        while parts:
            texts, again = ["".join(x) for x in parts], []
            for units, text, x, y in zip(parts, texts, p.a_ids(texts), p.b_ids(texts), strict=True):
                raw = text.encode()
                if p.same(raw, x, p.a_bytes) and p.same(raw, y, p.b_bytes):
                    kept += units
                    ids_a += x
                    ids_b += y
                elif len(units) == 1:
                    bad += units
                else:
                    again += [[u] for u in units]
            parts = again
        return kept, ids_a, ids_b, bad

    def learn(self, new: list[str]) -> None:
        """Tokens, groups and links of all new units at once: one after the other
        they are a text, in which the end of each unit is a common end."""
        kept, ids_a, ids_b, bad = self.tokens_of(new)
        a, b = tokens(ids_a, self.pair.a_size), tokens(ids_b, self.pair.b_size)
        ends, every = common_ends(a, b), np.union1d(a[1], b[1])
        groups = _groups(a, b, ends)
        last = np.cumsum([len(u.encode()) for u in kept], dtype=np.int64)
        cuts = [np.searchsorted(x, last, "right") for x in (a[1], b[1], ends, every)]
        numbers = np.zeros((len(new), 4), np.int64)
        for k, cut in enumerate(cuts):
            numbers[:len(kept), k] = np.diff(cut, prepend=0)
        at = 0
        for u, cut in zip(kept, cuts[2].tolist(), strict=True):
            self.of[u] = len(self.text)
            self.text.append(";".join(groups[at:cut]))
            at = cut
        for u in bad:
            self.of[u] = len(self.text)
            self.text.append("")
        self.numbers = np.concatenate([self.numbers, numbers])
        self.links = np.concatenate([self.links, links(a, b)])

    def whole(self, texts: list[bytes]) -> list[tuple | None]:
        """Of each text (a space and the document's text): n_a, n_b, n_groups, n_links,
        groups text, and the distinct pairs with their numbers of links; None where
        the bytes differ."""
        cut = [_UNIT.findall(t.decode()) for t in texts]
        units = set()
        for c in cut:
            units.update(c)
        new = units.difference(self.of)
        if len(self.text) + len(new) > UNITS:
            self.clear()
            new = units
        self.learn(sorted(new))
        get = self.of.__getitem__
        flat = [list(map(get, c)) for c in cut]
        size = np.array([len(c) for c in flat], np.int64)
        doc = np.repeat(np.arange(len(cut)), size)
        every = np.fromiter((u for c in flat for u in c), np.int64, int(size.sum()))
        sums = np.zeros((len(cut), 4), np.int64)
        for k in range(4):
            sums[:, k] = np.bincount(doc, self.numbers[every, k], len(cut))
        good = np.ones(len(cut), bool)
        good[doc[self.numbers[every, 2] == 0]] = False
        # the links of each unit, at each of its places
        n = self.numbers[every, 3]
        start = np.cumsum(self.numbers[:, 3]) - self.numbers[:, 3]
        at = np.repeat(start[every] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        keys, times = np.unique(np.repeat(doc, n).astype(np.uint64) << np.uint64(32) | self.links[at].astype(np.uint64), return_counts=True)
        bound = np.searchsorted(keys, np.arange(len(cut) + 1).astype(np.uint64) << np.uint64(32)).tolist()
        pairs, times = keys.astype("<u4"), times.astype("<u4")
        named = self.text.__getitem__
        out = [(*numbers, ";".join(map(named, units)), pairs[x:y], times[x:y]) if ok and units else None
               for numbers, units, ok, x, y in zip(sums.tolist(), flat, good.tolist(), bound, bound[1:], strict=False)]
        if any(len(u) > UNIT_BYTES for u in new):       # long units do not stay
            self.clear()
        return out


def tokens(ids: list[int], size: np.ndarray, at: int = 0) -> Tokens:
    got = np.array(ids, np.int64)
    return got, at + np.cumsum(size[got]) if len(got) else np.empty(0, np.int64)


# -- the monoid of fragments -------------------------------------------------------
class Fragment:
    """``prefix`` and ``suffix`` are (A tokens, B tokens); a suffix of None: no common
    end yet, everything is in the prefix."""

    def __init__(self, prefix: tuple[Tokens, Tokens], suffix: tuple[Tokens, Tokens] | None) -> None:
        self.prefix, self.suffix = prefix, suffix


Closed = tuple[Tokens, Tokens]


def _upto(t: Tokens, end: int) -> tuple[Tokens, Tokens]:
    k = int(np.searchsorted(t[1], end, "right"))
    return (t[0][:k], t[1][:k]), (t[0][k:], t[1][k:])


def _plus(x: tuple[Tokens, Tokens], y: tuple[Tokens, Tokens]) -> tuple[Tokens, Tokens]:
    return tuple((np.concatenate([p[0], q[0]]), np.concatenate([p[1], q[1]])) for p, q in zip(x, y, strict=True))


def _cut(both: tuple[Tokens, Tokens], end: int) -> tuple[tuple[Tokens, Tokens], tuple[Tokens, Tokens]]:
    (a, a2), (b, b2) = _upto(both[0], end), _upto(both[1], end)
    return (a, b), (a2, b2)


def fragment(a: Tokens, b: Tokens) -> tuple[Fragment, list[Closed]]:
    """The fragment of a chunk's tokens, and the groups closed in it."""
    ends = common_ends(a, b)
    if not len(ends):
        return Fragment((a, b), None), []
    prefix, rest = _cut((a, b), int(ends[0]))
    closed, suffix = _cut(rest, int(ends[-1]))
    return Fragment(prefix, suffix), [closed] if len(closed[0][0]) else []


def join(left: Fragment, right: Fragment) -> tuple[Fragment, list[Closed]]:
    """The product of two neighbours, and the groups that it closes."""
    middle = _plus(left.prefix if left.suffix is None else left.suffix, right.prefix)
    ends = common_ends(*middle)
    if not len(ends):           # the right one is open too, else its prefix ends in common
        return (Fragment(middle, None) if left.suffix is None else Fragment(left.prefix, middle)), []
    prefix = left.prefix
    if left.suffix is None:
        prefix, middle = _cut(middle, int(ends[0]))
    closed, rest = _cut(middle, int(ends[-1]))
    return Fragment(prefix, rest if right.suffix is None else right.suffix), [closed] if len(closed[0][0]) else []


# -- ranges of long texts -----------------------------------------------------------
def _b_start(raw: bytes, at: int) -> int:
    """The first place from ``at`` on where a space follows a character that is no white space."""
    if at == 0:
        return 0
    at = raw.find(b" ", at)
    while at >= 0:
        k = at - 1
        while k > 0 and raw[k] & 0xC0 == 0x80:
            k -= 1
        if not raw[k:at].decode("utf-8", "replace").isspace():
            return at
        at = raw.find(b" ", at + 1)
    return len(raw)


def ranges(raw: bytes, chunk: int) -> Iterator[tuple[int, int, bytes, bytes]]:
    """(A offset, B offset, A bytes, B bytes) of each range of a space and a text."""
    starts, b = [], 0
    for at in range(0, len(raw), chunk):
        b = b if b >= at and at else _b_start(raw, at)      # one search finds the place for all ranges before it
        m = _LETTER_DIGIT.search(raw, at - 1, min(b, len(raw))) if at else None
        starts.append((0 if at == 0 else min(m.end() if m else b, b), b))
    starts.append((len(raw), len(raw)))
    for (a, b), (a2, b2) in zip(starts, starts[1:], strict=False):
        yield a, b, raw[a:a2], raw[b:b2]


_TOKENS = ("pa_ids", "pa_ends", "pb_ids", "pb_ends", "sa_ids", "sa_ends", "sb_ids", "sb_ends")
_PIECE = "rid long, doc_id {id}, at long, ok boolean, n_a long, n_b long, n_groups long, n_links long, groups string, pairs binary, times binary"
_FRAGMENT = ", k long, " + ", ".join(f"{c} binary" for c in _TOKENS)


def _array(raw: bytes | None) -> np.ndarray:
    return np.frombuffer(raw or b"", np.int64)


def _piece(a: Tokens, b: Tokens, begin: int) -> tuple:
    """at, ok, n_a, n_b, n_groups, n_links, groups, pairs, times of closed groups."""
    ends = common_ends(a, b)
    pairs, times = np.unique(links(a, b), return_counts=True)
    return (begin, True, len(a[0]), len(b[0]), len(ends), int(times.sum()), groups_text(a, b, ends),
            pairs.astype("<u4").tobytes(), times.astype("<u4").tobytes())


def _store(f: Fragment) -> list[bytes | None]:
    out = [x.astype(np.int64).tobytes() for t in f.prefix for x in t]
    return out + ([None] * 4 if f.suffix is None else [x.astype(np.int64).tobytes() for t in f.suffix for x in t])


def _restore(row: dict) -> Fragment:
    v = [row[c] for c in _TOKENS]
    p = ((_array(v[0]), _array(v[1])), (_array(v[2]), _array(v[3])))
    return Fragment(p, None if v[4] is None else ((_array(v[4]), _array(v[5])), (_array(v[6]), _array(v[7]))))


class _Rows:
    """Rows of pieces and of fragments, of one schema."""

    def __init__(self, schema: pa.Schema) -> None:
        self.schema, self.rows, self.size = schema, [], 0

    def piece(self, rid: int, doc_id, closed: Closed) -> None:
        # a piece is known by where its first token ends
        self.rows.append((rid, doc_id, *_piece(*closed, int(closed[0][1][0])), None, *[None] * 8))
        self.size += 16 * len(closed[0][0])

    def fragment(self, rid: int, doc_id, k: int, ok: bool, f: Fragment) -> None:
        self.rows.append((rid, doc_id, None, ok, *[None] * 7, k, *_store(f)))
        self.size += 16 * len(f.prefix[0][0])

    def batch(self) -> pa.RecordBatch:
        cols = list(zip(*self.rows, strict=True)) if self.rows else [[] for _ in self.schema]
        self.rows, self.size = [], 0
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, self.schema, strict=True)], schema=self.schema)


def _arrow(id_type: pa.DataType) -> pa.Schema:
    return pa.schema([("rid", pa.int64()), ("doc_id", id_type), ("at", pa.int64()), ("ok", pa.bool_()),
                      *[(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")], ("groups", pa.string()),
                      ("pairs", pa.binary()), ("times", pa.binary()), ("k", pa.int64()), *[(c, pa.binary()) for c in _TOKENS]])


def _fragments(chunks: DataFrame, a_path: str, b_path: str, schema: str) -> DataFrame:
    """The fragment of each range, and the groups that are closed inside it."""
    def run(batches):
        pair = load(a_path, b_path)
        for batch in batches:
            rows = _Rows(_arrow(batch.schema.field("doc_id").type))
            for i in range(batch.num_rows):
                r = {c: column(batch, c)[i].as_py() for c in ("rid", "doc_id", "k", "a_at", "b_at", "a_text", "b_text")}
                x = pair.a_ids([r["a_text"].decode()])[0] if r["a_text"] else []
                y = pair.b_ids([r["b_text"].decode()])[0] if r["b_text"] else []
                ok = pair.same(r["a_text"], x, pair.a_bytes) and pair.same(r["b_text"], y, pair.b_bytes)
                f, closed = fragment(tokens(x if ok else [], pair.a_size, r["a_at"]), tokens(y if ok else [], pair.b_size, r["b_at"]))
                rows.fragment(r["rid"], r["doc_id"], r["k"], ok, f)
                for c in closed:
                    rows.piece(r["rid"], r["doc_id"], c)
                if rows.size > 1 << 23:
                    yield rows.batch()
            yield rows.batch()
    return chunks.mapInArrow(run, schema)


def _reduced(fragments: DataFrame, schema: str, last: bool) -> DataFrame:
    """One step of the tree: up to ``FAN`` neighbours become one fragment; groups that
    close on the way are pieces.  The last step closes the document as well."""
    dealt = (fragments.withColumn("to", F.floor(F.col("k") / FAN)).repartition("rid", "to")
             .sortWithinPartitions("rid", "to", "k"))

    def run(batches):
        rows, at, have = None, None, None

        def done() -> None:
            rid, to, doc_id = at
            ok, f = have
            if last and ok and len(f.prefix[0][0]):     # the document's start is a common end
                rows.piece(rid, doc_id, f.prefix)
            rows.fragment(rid, doc_id, to, ok, f)

        for batch in batches:
            rows = rows or _Rows(_arrow(batch.schema.field("doc_id").type))
            for r in batch.to_pylist():
                here = (r["rid"], r["to"], r["doc_id"])
                f = _restore(r)
                if here != at:
                    if at:
                        done()
                    at, have = here, (r["ok"], f)
                else:
                    joined, closed = join(have[1], f)
                    have = (have[0] and r["ok"], joined)
                    for c in closed:
                        rows.piece(r["rid"], r["doc_id"], c)
                if rows.size > 1 << 23:
                    yield rows.batch()
        if at:
            done()
            yield rows.batch()

    return dealt.mapInArrow(run, schema)


# -- documents ---------------------------------------------------------------------
def _first(docs: DataFrame, a_path: str, b_path: str, chunk: int) -> DataFrame:
    """Whole results of texts of one range (k null), and the ranges of longer ones."""
    need = pick(docs, "doc_id", "text").withColumn("rid", F.monotonically_increasing_id())
    kind = dict(need.dtypes)["doc_id"]
    names = ["rid", "doc_id", "n_a", "n_b", "n_groups", "n_links", "sha", "pairs", "times", "k", "last", "a_at", "b_at", "a_text", "b_text"]
    types = [pa.int64(), None, *[pa.int64()] * 4, pa.string(), pa.binary(), pa.binary(), *[pa.int64()] * 4, pa.binary(), pa.binary()]

    def run(batches):
        pair = load(a_path, b_path)
        units = pair.units = pair.units or Units(pair)       # kept from task to task
        for b in blocks(batches, "text"):
            ids, rids = column(b, "doc_id").to_pylist(), column(b, "rid").to_pylist()
            texts = utf8(column(b, "text"))
            short = [i for i, t in enumerate(texts) if 0 < len(t) <= chunk]
            whole = dict(zip(short, units.whole([b" " + texts[i] for i in short]), strict=True))
            rows = []
            for i, t in enumerate(texts):
                if len(t) <= chunk:
                    got = whole.get(i)
                    rows.append((rids[i], ids[i], 0, 0, 0, 0, "", b"", b"", *[None] * 6) if got is None else
                                (rids[i], ids[i], *got[:4], hashlib.sha256(got[4].encode()).hexdigest(),
                                 got[5].astype("<u4").tobytes(), got[6].astype("<u4").tobytes(), *[None] * 6))
                else:
                    parts = list(ranges(b" " + t, chunk))
                    rows += [(rids[i], ids[i], *[None] * 7, k, len(parts) - 1, *p) for k, p in enumerate(parts)]
            kinds = [column(b, "doc_id").type if n == "doc_id" else x for n, x in zip(names, types, strict=True)]
            # a long text comes back in several batches
            for at in range(0, max(len(rows), 1), 256 if len(rows) > b.num_rows else max(len(rows), 1)):
                some = rows[at:at + 256] if len(rows) > b.num_rows else rows
                cols = list(zip(*some, strict=True)) if some else [[] for _ in names]
                yield pa.RecordBatch.from_arrays([pa.array(c, x) for c, x in zip(cols, kinds, strict=True)], names=names)

    return need.mapInArrow(run, f"rid long, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, sha string, pairs binary, "
                                "times binary, k long, last long, a_at long, b_at long, a_text binary, b_text binary")


def _digests(pieces: DataFrame, kind: str) -> DataFrame:
    """Per long document, one pass over its pieces in order: sums and the digest of its groups."""
    dealt = pieces.select("rid", "doc_id", "at", "n_a", "n_b", "n_groups", "n_links", "groups").repartition("rid").sortWithinPartitions("rid", "at")
    names = ["rid", "doc_id", "n_a", "n_b", "n_groups", "n_links", "sha"]

    def run(batches):
        at, sums, sha, out, id_type = None, [], None, [], None
        for b in batches:
            id_type = column(b, "doc_id").type
            for r in b.to_pylist():
                if (r["rid"], r["doc_id"]) != at:
                    if at:
                        out.append((*at, *sums, sha.hexdigest()))
                    at, sums, sha = (r["rid"], r["doc_id"]), [0, 0, 0, 0], hashlib.sha256()
                elif r["groups"]:
                    sha.update(b";")
                sha.update(r["groups"].encode())
                sums = [x + r[c] for x, c in zip(sums, names[2:6], strict=True)]
        if at:
            out.append((*at, *sums, sha.hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c, x) for c, x in zip(zip(*out, strict=True), [pa.int64(), id_type, *[pa.int64()] * 4, pa.string()], strict=True)], names=names)

    return dealt.mapInArrow(run, f"rid long, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, sha string")


def _documents_of_pairs(whole: DataFrame) -> DataFrame:
    """(pair, n): how many of these rows hold each pair, added up within tasks."""
    def batch(parts: list[np.ndarray]) -> pa.RecordBatch:
        pairs, n = np.unique(np.concatenate(parts) if parts else np.empty(0, np.uint32), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(pairs.astype(np.int64)), pa.array(n.astype(np.int64))], names=["pair", "n"])

    def run(batches):
        parts, held = [], 0
        for b in batches:
            for raw in column(b, "pairs").to_pylist():
                parts.append(np.frombuffer(raw, "<u4"))
                held += len(parts[-1])
            if held > HELD_PAIRS:
                yield batch(parts)
                parts, held = [], 0
        yield batch(parts)

    return whole.select("pairs").mapInArrow(run, "pair long, n long")


def _flat(rows: DataFrame) -> DataFrame:
    """(rid, pair, times) of rows with packed pairs."""
    def run(batches):
        for b in batches:
            rid = np.asarray(column(b, "rid"))
            pairs, times = ([np.frombuffer(x, "<u4") for x in column(b, c).to_pylist()] for c in ("pairs", "times"))
            for at in range(0, len(pairs), 64):
                some = pairs[at:at + 64]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(rid[at:at + 64], [len(x) for x in some])), pa.array(np.concatenate(some).astype(np.int64)),
                                                  pa.array(np.concatenate(times[at:at + 64]).astype(np.int64))], names=["rid", "pair", "times"])
    return rows.select("rid", "pairs", "times").mapInArrow(run, "rid long, pair long, times long")


_tables: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}


def _table(parts: list[tuple[str, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (sorted), counts and whether each is the best of its A id."""
    key = parts[0][0] if parts else ""
    if key not in _tables:
        _tables.clear()
        raw = [(files.read(uri), n) for uri, n in parts]
        pairs = np.concatenate([np.frombuffer(r[:4 * n], "<u4") for r, n in raw]) if raw else np.empty(0, np.uint32)
        order = np.argsort(pairs)
        count = np.concatenate([np.frombuffer(r[4 * n:12 * n], "<i8") for r, n in raw]) if raw else np.empty(0, np.int64)
        best = np.concatenate([np.frombuffer(r[12 * n:], np.uint8) for r, n in raw]) if raw else np.empty(0, np.uint8)
        _tables[key] = (pairs[order], count[order], best[order])
    return _tables[key]


def _write_table(counts: DataFrame) -> list[tuple[str, int]]:
    folder = shared_dir(counts.sparkSession, "pair-table")

    def run(batches):
        got = [(np.asarray(column(b, "pair")), np.asarray(column(b, "n")), np.asarray(column(b, "best"))) for b in batches if b.num_rows]
        if got:
            pairs, n, best = (np.concatenate(x) for x in zip(*got, strict=True))
            uri = f"{folder}/{int(pairs[0])}-{len(pairs)}.bin"
            files.put(uri, [pairs.astype("<u4").tobytes(), n.astype("<i8").tobytes(), best.astype(np.uint8).tobytes()])
            yield pa.RecordBatch.from_arrays([pa.array([uri]), pa.array([len(pairs)], pa.int64())], names=["uri", "n"])

    return [(r["uri"], r["n"]) for r in counts.mapInArrow(run, "uri string, n long").collect()]


def _scored(rows: DataFrame, keep: list[str], table: list[tuple[str, int]]) -> DataFrame:
    """The columns ``keep`` of each row, and n_best and count_sum of its pairs."""
    need = rows.select(*keep, "pairs", "times")
    kinds = dict(need.dtypes)

    def run(batches):
        known, count, best = _table(table)
        for b in batches:
            raw = column(b, "pairs").to_pylist()
            ends = np.concatenate([[0], np.cumsum([len(x) // 4 for x in raw], dtype=np.int64)])
            at = np.searchsorted(known, np.frombuffer(b"".join(raw), "<u4"))
            times = np.frombuffer(b"".join(column(b, "times").to_pylist()), "<u4").astype(np.int64)
            sums = []
            for weight in (best, count):
                total = np.concatenate([[0], np.cumsum(times * weight[at])]) if len(at) else np.zeros(1, np.int64)
                sums.append(pa.array(total[ends[1:]] - total[ends[:-1]]))
            yield pa.RecordBatch.from_arrays([*[column(b, c) for c in keep], *sums], names=[*keep, "n_best", "count_sum"])

    return need.mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in keep) + ", n_best long, count_sum long")


def _joined(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """(rid, n_best, count_sum), by a join with counts of any size.  A pair may be in
    every document, so both sides are salted."""
    spread = counts.withColumn("salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
    flat = _flat(rows).withColumn("salt", F.pmod(F.xxhash64("rid"), F.lit(SALTS)).cast("int"))
    return (flat.join(spread, ["pair", "salt"]).groupBy("rid")
            .agg(F.sum(F.col("times") * F.col("best")).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum")))


def align(docs: DataFrame, a_path: str, b_path: str, chunk: int = CHUNK, table_pairs: int = TABLE_PAIRS) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    kind = dict(docs.dtypes)["doc_id"]
    first = written(_first(docs, a_path, b_path, chunk), "align-first")
    whole, ranged = first.where("k IS NULL"), first.where("k IS NOT NULL")
    most = ranged.agg(F.max("last")).first()[0]
    counts, long_docs, pieces = _documents_of_pairs(whole), None, None
    if most is not None:
        schema = _PIECE.format(id=kind) + _FRAGMENT
        level = written(_fragments(ranged.repartition("rid", "k"), a_path, b_path, schema), "align-fragments")
        pieces = level.where("k IS NULL")
        while True:
            most //= FAN
            level = written(_reduced(level.where("k IS NOT NULL"), schema, last=most == 0), "align-tree")
            pieces = pieces.unionByName(level.where("k IS NULL"))
            if most == 0:
                break
        ends = level.where("k IS NOT NULL").select("rid", "doc_id", "ok")
        pieces = written(pieces.drop("k", "doc_id", "ok", *_TOKENS).join(ends.where("ok"), "rid"), "align-pieces")
        counts = counts.unionByName(_flat(pieces).select("rid", "pair").distinct().groupBy("pair").agg(F.count(F.lit(1)).alias("n")))
        zeros = ends.where("NOT ok").select("rid", "doc_id", *[F.lit(0).cast("long").alias(c) for c in ("n_a", "n_b", "n_groups", "n_links")], F.lit("").alias("sha"))
        long_docs = _digests(pieces, kind).unionByName(zeros)
    counts = written(counts.groupBy("pair").agg(F.sum("n").alias("n")), "align-counts")
    a_id = F.shiftrightunsigned("pair", 16)
    top = counts.groupBy(a_id.alias("a")).agg(F.max("n").alias("most"))
    counts = written(counts.withColumn("a", a_id).join(top, "a").select("pair", "n", (F.col("n") == F.col("most")).cast("int").alias("best")), "align-best")
    table = _write_table(counts) if counts.count() <= table_pairs else None
    keep = ["rid", "doc_id", "n_a", "n_b", "n_groups", "n_links", "sha"]
    out = whole.select(*keep).join(_joined(whole, counts), "rid", "left") if table is None else _scored(whole, keep, table)
    if long_docs is not None:
        sums = (_joined(pieces, counts) if table is None else _scored(pieces, ["rid"], table).groupBy("rid")
                .agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")))
        out = out.unionByName(long_docs.join(sums, "rid", "left"))
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")],
                      F.col("sha").alias("groups_sha256"))
