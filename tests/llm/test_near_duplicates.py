import inspect
import random
from math import comb

import numpy as np
import pytest

from firmo.llm import near_duplicates as N
from firmo.llm.common import Words

RND = random.Random(5)
VOCAB = [f"w{i}" for i in range(400)]


def shingles(text):
    w = Words([(text or "").encode()])
    words = [bytes(w.low[a:b]) for a, b in zip(w.starts, w.ends)]
    return {tuple(words[i:i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def brute(rows):
    """class_id and n_links by comparing every pair."""
    sets = [shingles(t) for _, t in rows]
    n = len(rows)
    link = [[i != j and bool(sets[i]) and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]) for j in range(n)] for i in range(n)]
    group = list(range(n))
    for _ in range(n):
        for i in range(n):
            for j in range(n):
                if link[i][j]:
                    group[i] = group[j] = min(group[i], group[j])
    first = {g: min(rows[i][0] for i in range(n) if group[i] == g) for g in group}
    return sorted((rows[i][0], first[group[i]], sum(link[i])) for i in range(n))


def mutate(words, n):
    words = list(words)
    for _ in range(n):
        words[RND.randrange(len(words))] = RND.choice(VOCAB)
    return words


@pytest.fixture(scope="module")
def group():
    base = [RND.choice(VOCAB) for _ in range(120)]
    rows = [(i, " ".join(mutate(base, RND.choice([0, 1, 2, 3, 4])))) for i in range(60)]
    rows += [(100 + i, " ".join(RND.choice(VOCAB) for _ in range(80))) for i in range(10)]
    rows += [(200 + i, "one short line") for i in range(5)] + [(300, ""), (301, None), (302, " .. ")]
    return rows


def result(df):
    return sorted((r["doc_id"], r["class_id"], r["n_links"]) for r in df.collect())


def test_one_large_group_equals_brute_force(make_docs, group):
    assert result(N.join(make_docs(group))) == brute(group)


def test_blocks_of_a_group_give_the_same(make_docs, group, monkeypatch):
    monkeypatch.setattr(N, "UNIT", 7)
    assert result(N.join(make_docs(group))) == brute(group)


def test_without_broadcast_gives_the_same(make_docs, group, monkeypatch):
    monkeypatch.setattr(N, "BROADCAST_ROWS", -1)
    assert result(N.join(make_docs(group))) == brute(group)


def test_edges(edge_docs, no_docs):
    got = {(r["doc_id"], r["class_id"], r["n_links"], r["n_copies"]) for r in N.join(edge_docs).collect()}
    assert {(1, 1, 0, 1), (2, 2, 0, 1), (3, 3, 0, 1), (4, 4, 2, 3), (5, 4, 2, 3)} <= got
    assert N.join(edge_docs).count() == edge_docs.count()
    assert N.join(no_docs).count() == 0


def test_one_of_each_group_stays(make_docs, edge_docs, no_docs, group):
    docs = make_docs(group + [(0, group[0][1])])
    kept = N.keep_one(docs)
    assert kept.columns == docs.columns
    want = sorted({c for _, c, _ in brute(group)})
    assert sorted(r["doc_id"] for r in kept.collect()) == want
    assert sorted(r["doc_id"] or -1 for r in N.keep_one(edge_docs).collect()) == [-1, 1, 2, 3, 4, 6, 7, 8]
    assert N.keep_one(no_docs).count() == 0


def test_components_of_a_long_chain(spark):
    rows = [(i.to_bytes(2, "big"), (i + 1).to_bytes(2, "big")) for i in range(300)] + [(b"\x09\x09", b"\x09\x08")]
    got = dict(N.components(spark.createDataFrame(rows, "u binary, v binary")).collect())
    assert {bytes(v) for k, v in got.items() if k < b"\x09"} == {b"\0\0"}
    assert bytes(got[b"\x09\x09"]) == b"\x09\x08"


def test_posterior_bound_keeps_true_pairs():
    least = N.fewest_matches(0.8, 1e-4)
    assert all(a < b for a, b in zip(list(least.values()), list(least.values())[1:]))
    r = np.random.default_rng(1)
    lost = sum(any((x[:n]).sum() < m for n, m in least.items()) for x in r.random((20000, N.HASHES)) < 0.8)
    assert lost < 60


def test_bands_and_pruning_lose_less_than_one_in_a_million():
    """Exact binomial odds that a pair at the threshold is missed by all bands or
    pruned before the exact check, with the default tolerance."""
    least = N.fewest_matches(0.8, inspect.signature(N.join).parameters["tolerance"].default)
    for p in (0.8, 0.82, 0.85, 0.9):
        odds, pruned = {0: 1.0}, 0.0
        for n in range(N.STEP, N.HASHES + 1, N.STEP):
            after: dict[int, float] = {}
            for m, q in odds.items():
                for k in range(N.STEP + 1):
                    after[m + k] = after.get(m + k, 0) + q * comb(N.STEP, k) * p ** k * (1 - p) ** (N.STEP - k)
            pruned += sum(q for m, q in after.items() if m < least.get(n, 0))
            odds = {m: q for m, q in after.items() if m >= least.get(n, 0)}
        assert pruned < 1e-7 and (1 - p ** N.ROWS) ** N.BANDS + pruned < 1e-6


def test_rows_are_judged_by_id_and_text(make_docs):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    docs = make_docs([(1, a), (5, a), (5, b), (None, a + " more"), (None, c), (None, c), (None, ""), (None, "")])
    got = sorted(((r["doc_id"] or -1), r["text"]) for r in N.keep_one(docs).collect())
    assert got == sorted([(1, a), (5, b), (-1, c), (-1, ""), (-1, "")])
