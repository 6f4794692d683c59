"""Spelling variants: pairs of vocabulary words one edit apart, by composing the
vocabulary acceptor with a one-edit transducer and the acceptor again.

The composed machine V o T o V starts in (q, no edit, q), where q is the state of V
after some letters that both words share, and the edit comes later.  Every pair one
edit apart shares the first or the last half of its shorter word, so the initial
states "after the first half", and the same for the reversed acceptor, cover all
pairs.  A partition holds the words that pass through one initial state; its task
builds the minimised acceptor of what is left of them, composes it with T and
itself, and enumerates the accepted pairs.  Partitions of more than ``GROUP`` words
are cut again by the halves of what is left, which ends: with one letter left there
are at most 90 + 90 * 90 words.

Words, counts and pairs are Spark tables; nothing of them reaches the driver but two
maxima (the largest partition and the largest count).

Defined results: a null text has no words; a null id stands in the hashed string as
the empty text; repeated rows count each; an empty table gives an empty result;
further columns of any name are left out."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from firmo.llm.common import blocks, column, pick, utf8, written

LETTERS = "A-Za-zÀ-ÿ"
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: a task's table of counts is sent on when it holds so many words
HELD = 200_000
#: words of one partition that a task composes at once
GROUP = 20_000
_OUT = 50_000


# -- words ---------------------------------------------------------------------
def word_counts(docs: DataFrame, least_chars: int = 6, least_n: int = 5, one_in: int = 199) -> DataFrame:
    """(word, n): runs of letters, A-Z lower-cased.  Where ``one_in`` divides the
    crc32 of ``<doc_id>:<run>``, the run loses the letter at that hash modulo its length."""
    need = pick(docs, "doc_id", "text")
    # a shorter run stays shorter: only runs that can count are looked at
    runs = re.compile(f"[{LETTERS}]{{{max(1, least_chars)},}}")

    def batch(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

    def run(batches):
        held: Counter = Counter()
        for b in blocks(batches, "text"):
            for i, text in zip(column(b, "doc_id").to_pylist(), utf8(column(b, "text")), strict=True):
                here = Counter(runs.findall(text.translate(_LOWER).decode()))
                start = zlib.crc32(f"{'' if i is None else i}:".encode())
                for w in [w for w in here if zlib.crc32(w.encode(), start) % one_in == 0]:
                    at = zlib.crc32(w.encode(), start) % len(w)
                    n, less = here.pop(w), w[:at] + w[at + 1:]
                    if len(less) >= least_chars:
                        held[less] += n
                held.update(here)
            if len(held) > HELD:
                yield batch(held)
                held = Counter()
        yield batch(held)

    return (need.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= least_n))


# -- automata ------------------------------------------------------------------
class Acceptor:
    """The minimal acyclic automaton of sorted, distinct words.  ``arcs[q]`` maps a
    letter to (state, number of accepted words that branch off before it), so a path
    adds up to the position of its word in the sorted list."""

    def __init__(self, words: Iterable[str]) -> None:
        self.final: list[bool] = []
        self.arcs: list[dict[str, tuple[int, int]]] = []
        self.count: list[int] = []
        self.low: list[int] = []        # letters up to the nearest and the farthest end
        self.high: list[int] = []
        self._known: dict[tuple, int] = {}
        path: list[tuple[str, dict[str, int], bool]] = []      # open states: letter into, arcs, accepting
        top: list = [{}, False]
        last = ""
        for w in words:
            same = 0
            for x, y in zip(w, last, strict=False):
                if x != y:
                    break
                same += 1
            self._close(path, top, same)
            for c in w[same:]:
                path.append((c, {}, False))
            if path:
                c, arcs, _ = path[-1]
                path[-1] = (c, arcs, True)
            else:
                top[1] = True
            last = w
        self._close(path, top, 0)
        self.start = self._state(top[0], top[1])
        del self._known

    def _close(self, path: list, top: list, keep: int) -> None:
        while len(path) > keep:
            c, arcs, accepting = path.pop()
            (path[-1][1] if path else top[0])[c] = self._state(arcs, accepting)

    def _state(self, arcs: dict[str, int], accepting: bool) -> int:
        sign = (accepting, *arcs.items())
        q = self._known.get(sign)
        if q is None:
            q = self._known[sign] = len(self.final)
            before, out = int(accepting), {}
            for c, child in arcs.items():
                out[c] = (child, before)
                before += self.count[child]
            self.final.append(accepting)
            self.arcs.append(out)
            self.count.append(before)
            self.low.append(0 if accepting else min((self.low[p] + 1 for p in arcs.values()), default=0))
            self.high.append(max((self.high[p] + 1 for p in arcs.values()), default=0))
        return q


class OneEdit:
    """V o T o V: T copies letters, and inserts, deletes or replaces exactly one."""

    def __init__(self, v: Acceptor) -> None:
        self.v = v
        self._common: dict[tuple[int, int], list[tuple[int, int]]] = {}

    def common(self, p: int, q: int) -> list[tuple[int, int]]:
        """After the edit: the words accepted from both states, as positions in each."""
        v = self.v
        if p == q:
            return [(k, k) for k in range(v.count[p])]
        if v.low[p] > v.high[q] or v.low[q] > v.high[p] or (
                not (v.final[p] and v.final[q]) and v.arcs[p].keys().isdisjoint(v.arcs[q])):
            return []
        got = self._common.get((p, q))
        if got is None:
            got, open_ = [], [(p, q, 0, 0)]
            while open_:
                a, b, x, y = open_.pop()
                if a == b:
                    got += [(x + k, y + k) for k in range(v.count[a])]
                    continue
                if v.low[a] > v.high[b] or v.low[b] > v.high[a]:
                    continue
                if v.final[a] and v.final[b]:
                    got.append((x, y))
                one, other = v.arcs[a], v.arcs[b]
                for c in one.keys() & other.keys():
                    (a2, dx), (b2, dy) = one[c], other[c]
                    open_.append((a2, b2, x + dx, y + dy))
            self._common[p, q] = got
        return got

    def edits(self, q: int) -> list[tuple[int, int]]:
        """Pairs whose words part in state q: a letter more in one, or another letter."""
        v = self.v
        arcs, out = list(v.arcs[q].items()), []
        for i, (c, (p1, d1)) in enumerate(arcs):
            if v.final[p1] and v.final[q]:
                out.append((d1, 0))
            # after a further letter the words go on with anything but that letter,
            # else they would part later
            for e in v.arcs[p1].keys() & v.arcs[q].keys():
                if e != c:
                    (a, dx), (b, dy) = v.arcs[p1][e], v.arcs[q][e]
                    out += [(d1 + dx + x, dy + y) for x, y in self.common(a, b)]
            for _, (p2, d2) in arcs[i + 1:]:
                out += [(d1 + x, d2 + y) for x, y in self.common(p1, p2)]
        return out

    def pairs(self) -> Iterator[tuple[int, int]]:
        """Every unordered pair of accepted words one edit apart, once, as positions."""
        of: dict[int, list[tuple[int, int]]] = {}
        open_ = [(self.v.start, 0)]
        while open_:
            q, base = open_.pop()
            if self.v.count[q] < 2:
                continue
            if q not in of:
                of[q] = self.edits(q)
            for x, y in of[q]:
                yield base + x, base + y
            open_ += [(p, base + d) for p, d in self.v.arcs[q].values()]


# -- partitions by initial state -------------------------------------------------
def _initial_states(left: DataFrame, own_length: bool) -> DataFrame:
    """The initial states a word passes through.  ``key`` names one, ``rest`` is what
    is left of the word, read away from the shared half, ``r`` the length left of
    the shorter words of the partition."""
    size = F.length("rest")
    forms = []
    for r in ([size, size - 1] if own_length else [F.col("r")]):
        h = F.floor(r / 2).cast("int")
        for side, key, rest, left_over in (
                ("P", F.substring("rest", F.lit(1), h), F.substring("rest", h + 1, size), r - h),
                ("S", F.substring("rest", size - (r - h) + 1, size), F.reverse(F.substring("rest", F.lit(1), size - (r - h))), h)):
            forms.append(F.when(r >= (6 if own_length else 2), F.struct(
                F.concat(F.col("key"), F.lit(side), r.cast("string"), F.lit(":"), key, F.lit(";")).alias("key"),
                rest.alias("rest"), left_over.cast("int").alias("r"))))
    return left.select("word", "n", F.explode(F.array_compact(F.array(*forms))).alias("s")).select("word", "n", "s.*")


def _partitions(words: DataFrame, group: int) -> Iterator[DataFrame]:
    """Tables of (word, n, key, rest, r) whose keys hold at most ``group`` words, or
    leave words of at most two letters.  Each key with two words and more is in one."""
    left, first = words.select("word", "n", F.lit("").alias("key"), F.col("word").alias("rest"), F.lit(0).alias("r")), True
    while True:
        left = _initial_states(left, first)
        # the number of a key's words, by a partial aggregate; most keys have one word
        sizes = left.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
        left = written(left.join(sizes, "key"), "spelling-states")
        yield left.where((F.col("members") <= group) | (F.col("r") < 2)).drop("members")
        left, first = left.where((F.col("members") > group) & (F.col("r") >= 2)).drop("members"), False
        if left.isEmpty():
            return


def _compose(part: DataFrame) -> DataFrame:
    """(word, near, near_n), in both directions, of one table of partitions.  A pair
    may come from more than one partition."""
    dealt = part.repartition("key").sortWithinPartitions("key", "rest")

    def found(members: list[tuple[str, str, int]], r: int, out: list[list]) -> None:
        v = Acceptor([m[0] for m in members])
        for x, y in OneEdit(v).pairs():
            (a, w1, n1), (b, w2, n2) = members[x], members[y]
            if len(a) == r or len(b) == r:      # two longer words meet in a partition of their own
                out[0] += (w1, w2)
                out[1] += (w2, w1)
                out[2] += (n2, n1)

    def batch(out: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.string()), pa.array(out[2], pa.int64())],
                                          names=["word", "near", "near_n"])

    def run(batches):
        key, members, r, out = None, [], 0, [[], [], []]
        for b in batches:
            for k, rest, w, n, left in zip(*(column(b, c).to_pylist() for c in ("key", "rest", "word", "n", "r")), strict=True):
                if k != key:
                    found(members, r, out)
                    if len(out[0]) > _OUT:
                        yield batch(out)
                        out = [[], [], []]
                    key, members, r = k, [], left
                members.append((rest, w, n))
        found(members, r, out)
        yield batch(out)

    return dealt.mapInArrow(run, "word string, near string, near_n long")


def near_pairs(words: DataFrame, group: int = GROUP) -> DataFrame:
    """(word, near, near_n): all ordered pairs of ``words`` (word, n; words distinct, of
    6 letters at least) one inserted, deleted or replaced letter apart."""
    out = None
    for part in _partitions(words, group):
        found = _compose(part)
        out = found if out is None else out.unionByName(found)
    return out.dropDuplicates(["word", "near"])


# -- forms and roots -------------------------------------------------------------
def group_variants(words: DataFrame, times: int = 5, group: int = GROUP) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of a table (word, n)."""
    words = written(words, "spelling-words")
    near = (near_pairs(words, group=group).groupBy("word")
            .agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word"))).alias("best")))
    best, n = F.col("best.word"), -F.col("best.n")
    out = (words.join(near, "word", "left")
           .select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                   F.when(n >= times * F.col("n"), best).alias("form"), F.when(n >= times * F.col("n"), n).alias("form_n")))
    out = written(out, "spelling-forms")
    # a form is `times` as frequent as its word: chains have at most log(max n) steps, and
    # each round doubles the steps taken
    most = out.agg(F.max("n")).first()[0] or 1
    steps, rounds = 1, 0
    while times ** steps <= most:
        steps += 1
    while (1 << rounds) < steps:
        rounds += 1
    hops = out.where("form IS NOT NULL").select("word", F.col("form").alias("to"))
    for _ in range(rounds):
        ahead = hops.select(F.col("word").alias("to"), F.col("to").alias("further"))
        hops = written(hops.join(ahead, "to", "left").select("word", F.coalesce("further", "to").alias("to")), "spelling-hops")
    return (out.join(hops, "word", "left")
            .select("word", "form", F.coalesce("to", "word").alias("root"), "n", "n_near", "form_n"))


def query(docs: DataFrame) -> DataFrame:
    """Variants of the words of at least 6 letters and 5 occurrences in ``documents``."""
    return group_variants(word_counts(docs))
