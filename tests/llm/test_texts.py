"""License scans, decontamination and personal data against brute force."""
import hashlib
import random
import re

import numpy as np
import pytest

from firmo.llm import decontaminate as D
from firmo.llm import licenses as L
from firmo.llm import pii as P

RND = random.Random(9)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


# -- licenses -----------------------------------------------------------------

def test_base_places_and_rules(make_docs, edge_docs, no_docs):
    texts = ["Under the MIT License. mit\nlicense", "GNU General  Public License, version 3 or later", "cc-by-nc 4.0; CC BY 4.0", "commit license", "Apache License, Version 2.0",
             "SPDX-License-Identifier: MPL-2.0", "mit license" * 2, "", None, "é mit license é"]
    rows = {r["doc_id"]: r for r in L.query(make_docs(list(enumerate(texts)))).collect()}
    for i, t in enumerate(texts):
        w = words(t)
        at = [(k, label) for p, label in L.BASE.items() for k in range(len(w)) if w[k:k + len(p.split())] == p.split()]
        r = rows[i]
        assert (r["n_words"], r["n_base"]) == (len(w), len(at))
        assert (r["first_word"], r["last_word"]) == (min([k for k, _ in at], default=None), max([k for k, _ in at], default=None))
        assert r["base_labels"] == ",".join(sorted({x for _, x in at}))
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1
    assert "gpl-3" in rows[1]["labels"] and "apache-2.0" in rows[4]["labels"] and "mpl-2.0" in rows[5]["labels"]
    assert "cc-by-nc-4.0" in rows[2]["labels"]
    assert L.query(edge_docs).count() == edge_docs.count() and L.query(no_docs).count() == 0


def test_overlaps_are_resolved_by_priority():
    got = L.scanner().detect(b"licensed under the gnu lesser general public license, version 2.1")
    assert [d[2] for d in got] == ["lgpl-2.1"]
    assert len(L.rules()) > 300


def test_spdx_rules_once_and_for_every_family():
    every = [(r.label, r.pattern.pattern) for r in L.rules()]
    assert len(every) == len(set(every))
    for label, _, versions in L.FAMILIES:
        for name in [label, *(f"{label}-{v}" for v in versions)]:
            assert [d[2] for d in L.scanner().detect(f"// spdx-license-identifier: {name}\n".encode())] == [name]
    assert [d[2] for d in L.scanner().detect(b"spdx-license-identifier: mit-0")] == ["spdx"]


# -- decontamination -------------------------------------------------------------

def brute_hits(text, items, window=13):
    w = words(text)
    hit, names = set(), set()
    for name, t in items:
        x = words(t)
        n = min(len(x), window)
        for k in range(len(x) - n + 1 if n else 0):
            for p in range(len(w) - n + 1):
                if w[p:p + n] == x[k:k + n]:
                    hit.update(range(p, p + n))
                    names.add(name)
    return len(w), len(hit), sorted(names)


@pytest.fixture(scope="module")
def contaminated():
    vocab = [f"t{i}" for i in range(12)]
    items = [(f"i{k}", " ".join(RND.choice(vocab) for _ in range(RND.choice([0, 1, 3, 12, 13, 14, 40])))) for k in range(25)]
    items += [("i3", items[3][1]), ("same", items[5][1])]
    texts = []
    for k in range(60):
        w = [RND.choice(vocab) for _ in range(RND.choice([5, 60, 300]))]
        if k % 3 == 0:
            x = items[RND.randrange(len(items))][1].split()
            at = RND.randrange(len(w))
            w[at:at] = x
        texts.append(" ".join(w).title())
    return items, [*texts, "", None]


@pytest.mark.parametrize("shard", [D.SHARD_WORDS, 40])
def test_windows_equal_brute_force(spark, make_docs, contaminated, shard):
    items, texts = contaminated
    got, spans, names, n = D.mark(make_docs(list(enumerate(texts))), spark.createDataFrame([(i, t, 1) for i, t in items], "item_id string, text string, doc_id int"), shard_words=shard)
    for r in got.collect():
        want = brute_hits(texts[r["doc_id"]], items)
        hit = sum(b - a for a, b in zip(r[spans][::2], r[spans][1::2]))
        assert (r[n], hit, r[names]) == want


def test_contamination_query_and_cleaning(spark, make_docs, edge_docs, no_docs):
    item = " ".join(f"q{i}" for i in range(20))
    bench = spark.createDataFrame([(7, item), (8, None), (None, "z")], "item_id long, text string")
    long = " ".join(f"a{i}" for i in range(2000))
    docs = make_docs([(1, f"x {item} y"), (2, f"{long} {item.upper()} end"), (3, "clean z text"), (4, None)])
    got = {r["doc_id"]: r for r in D.query(docs, bench).collect()}
    assert [got[i]["contaminated"] for i in (1, 2, 3, 4)] == [True, False, False, False]
    assert got[2]["n_hit"] == 20 and got[1]["items_sha256"] == hashlib.sha256(b"7").hexdigest()
    kept = {r["doc_id"]: r for r in D.clean(docs, bench).collect()}
    assert sorted(kept) == [2, 3, 4] and kept[4]["text"] is None
    assert "q5" not in kept[2]["text"].lower() and kept[2]["text"].startswith("a0") and kept[2]["text"].endswith("end")
    assert kept[2]["n_chars"] == len(kept[2]["text"])
    none = spark.createDataFrame([], bench.schema)
    assert D.query(edge_docs, none).where("contaminated").count() == 0
    assert D.clean(edge_docs, bench).columns == edge_docs.columns and D.query(no_docs, bench).count() == 0


def test_no_item_reaches_the_driver(spark, make_docs, contaminated, monkeypatch):
    """Shards are built in tasks: the driver neither builds nor reads items."""
    items, texts = contaminated
    bench = spark.createDataFrame(items, "item_id string, text string")

    def never(*_):
        raise AssertionError("an item on the driver")

    monkeypatch.setattr(type(bench), "toLocalIterator", never)
    monkeypatch.setattr(spark.sparkContext, "broadcast", never)
    got, spans, names, n = D.mark(make_docs(list(enumerate(texts[:12]))), bench, shard_words=40)
    for r in got.collect():
        hit = sum(b - a for a, b in zip(r[spans][::2], r[spans][1::2]))
        assert (r[n], hit, r[names]) == brute_hits(texts[r["doc_id"]], items)


# -- personal data ------------------------------------------------------------------

PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def brute_spans(text):
    out = []
    for k, p in enumerate(PATTERNS):
        for m in re.finditer(p, text):
            d = re.sub("[^0-9]", "", m[0])
            s = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d)))
            if [True, all(int(x) <= 255 for x in m[0].split(".")) if k == 1 else True, 16 <= len(d) <= 19 and s % 10 == 0, 8 <= len(d) <= 15][k]:
                out.append((k, m.start(), m.end()))
    return out


def test_base_spans_equal_the_patterns():
    for _ in range(20_000):
        t = "".join(RND.choice("ab1123@@...+-_ ()é") for _ in range(RND.randint(0, 40)))
        assert P.base_spans(t) == brute_spans(t), t
    assert P.base_spans("4111 1111 1111 1111") == [(2, 0, 19)]
    assert P.base_spans("a" * 50_000 + "@") == []


def test_gradients_are_those_of_the_loss():
    m = P.Tagger.fresh(4)
    m.w = {k: v.astype(np.float64) for k, v in m.w.items()}
    x = np.random.default_rng(0).integers(0, P.CHARS, (3, 6))
    y = np.array([[0, 1, 2, 0, 3, 4], [0, 0, 0, 5, 6, 6], [7, 8, 0, 0, 0, 1]])
    _, g = m.gradients(x, y)
    for k, w in m.w.items():
        at = np.unravel_index(np.abs(g[k]).argmax(), w.shape)
        own, step = w[at], 1e-3
        w[at] = own + step
        up, _ = m.gradients(x, y)
        w[at] = own - step
        down, _ = m.gradients(x, y)
        w[at] = own
        assert abs(g[k][at] - (up - down) / 2 / step) < 1e-3 * max(1, abs(g[k][at]))


@pytest.fixture(scope="module")
def private():
    def one():
        return RND.choice([f"user{RND.randrange(99)}@mail{RND.randrange(9)}.example.com", ".".join(str(RND.randrange(256)) for _ in range(4)),
                           f"+1 ({RND.randrange(100, 999)}) 555-{RND.randrange(1000, 9999)}"])
    return [" ".join(["some plain words"] * RND.randint(1, 5) + [one()] + ["and more of them"] * RND.randint(1, 40) + ([one()] if RND.random() < 0.4 else []))
            for _ in range(250)]


def test_tagger_learns_the_spans(private):
    windows = [w for t in private[:200] for w in P.training_windows(t, 8, 3)]
    model = P.fit(windows, steps=160)
    want = found = 0
    for t in private[200:]:
        got = P.decode(model, [t])[0]
        want += len(P.base_spans(t))
        found += sum(s in got for s in P.base_spans(t))
    assert found / want > 0.8
    # a span across several windows is one span
    far = "x" * 50 + " " + "9" * (3 * P.WINDOW) + " y"
    assert all(b > a for _, a, b in P.decode(model, [far])[0])


def test_query_keeps_base_spans(spark, make_docs, private, edge_docs, no_docs):
    rows = {r["doc_id"]: r for r in P.query(make_docs(list(enumerate([*private, "", None])))).collect()}
    for i, t in enumerate(private):
        base = brute_spans(t)
        line = [f"{P.KINDS[k]}:{a}:{b}" for k, a, b in base]
        assert rows[i]["base_sha256"] == hashlib.sha256(",".join(line).encode()).hexdigest()
        assert set(line) <= set(rows[i]["spans"].split(","))
        assert [rows[i][f"n_{k}"] for k in P.KINDS] == [sum(s[0] == n for s in base) for n in range(4)]
    assert rows[len(private)]["spans"] == "" and rows[len(private) + 1]["n_email"] == 0
    assert P.query(edge_docs).count() == edge_docs.count() and P.query(no_docs).count() == 0


def test_redaction(make_docs):
    docs = make_docs([(1, "write to a.b@mail.example.com now"), (2, None), (3, "no data")])
    got = {r["doc_id"]: r for r in P.redact(docs).collect()}
    assert got[1]["text"] == "write to [EMAIL] now" and got[1]["n_chars"] == len(got[1]["text"])
    assert got[2]["text"] is None and got[3]["text"] == "no data"
