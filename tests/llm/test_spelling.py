"""Spelling variants: the automata and the whole operator against plain Python."""
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from firmo.llm import spelling as sp

RND = random.Random(13)


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    i = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[i:] == b[i + 1:]


def plain_words(rows):
    n = Counter()
    for doc_id, text in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for w in re.findall("[A-Za-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if h % 199 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    return {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}


def plain(n):
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] is not None else None))
    return sorted(out)


def got(df):
    return sorted((r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect())


@pytest.mark.parametrize("words", [[], ["a"], ["", "a", "b", "ab"], ["abc", "abd", "ab", "bc", "abcd", "xabc", "acc"], ["aaaa", "aaa", "aa"]])
def test_acceptor_and_composition(words):
    words = sorted(words)
    v = sp.Acceptor(words)
    assert v.count[v.start] == len(words)
    got_pairs = {frozenset(p) for p in sp.OneEdit(v).pairs()}
    assert got_pairs == {frozenset((i, j)) for i in range(len(words)) for j in range(i) if one_edit(words[i], words[j])}


def test_acceptor_is_minimal_and_takes_long_words():
    ends = sorted(x + y for x in ("work", "play", "walk") for y in ("s", "ed", "ing"))
    assert len(sp.Acceptor(ends).final) < len(set("".join(ends))) + 8
    a, b = "x" * 30_000, "x" * 15_000 + "y" + "x" * 14_999
    assert {frozenset(p) for p in sp.OneEdit(sp.Acceptor([a, b])).pairs()} == {frozenset((0, 1))}


def test_random_vocabularies():
    for k in range(20):
        words = sorted({"".join(RND.choice("abé") for _ in range(RND.randint(0, 6))) for _ in range(60)})
        found = {frozenset(p) for p in sp.OneEdit(sp.Acceptor(words)).pairs()}
        assert found == {frozenset((i, j)) for i in range(len(words)) for j in range(i) if one_edit(words[i], words[j])}, k


@pytest.mark.parametrize("group", [20_000, 3])
def test_variants(spark, group):
    """With partitions of three words the hot ones are cut again and again."""
    words = {"".join(RND.choice("abcÿ") for _ in range(RND.randint(6, 9))): RND.choice([5, 6, 25, 30, 125, 150, 700]) for _ in range(250)}
    words |= {w[:i] + RND.choice("abc") + w[i + RND.randint(0, 1):]: RND.choice([5, 30, 170]) for w in list(words) for i in [RND.randrange(6)]}
    words = {w: n for w, n in words.items() if len(w) >= 6}
    words |= {"q" * k: 10 ** (k - 5) for k in range(6, 12)}
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    assert got(sp.group_variants(df, group=group)) == plain(words)


def test_whole_operator(spark, make_docs, edge_docs, no_docs):
    base = ["thereon", "theréon", "thereons", "Thereon", "elsewhere", "short", "elsewhre", "ÀÉ×÷ÿabc", "x1thereon"]
    rows = [(RND.choice([None, *range(40)]), " ".join(RND.choice(base) for _ in range(RND.randint(0, 400)))) for _ in range(60)]
    rows += [(1, None), (1, ""), *[(i, "thereonz " + "a" * 5000 + " " + "a" * 5001) for i in range(5)]]
    want = plain(plain_words(rows))
    assert len(want) >= 8 and any(w[1] for w in want)
    assert got(sp.query(make_docs(rows).repartition(3))) == want
    edge = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    assert got(sp.query(edge_docs)) == plain(plain_words(edge))
    assert sp.query(no_docs).count() == 0
    assert sp.word_counts(make_docs(rows)).agg(F.sum("n")).first()[0] == sum(plain_words(rows).values())
