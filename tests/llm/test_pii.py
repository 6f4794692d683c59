"""The tagger: emissions, whole-text decoding against a plain search, added spans."""
import random
import time

import numpy as np
import pytest

from firmo.llm import pii as P

RND = random.Random(8)
WORDS = "the of reach me call write or visit item code note plan".split()


def text(n=60):
    out = [RND.choice(WORDS) for _ in range(n)]
    for _ in range(RND.randint(0, 3)):
        out[RND.randrange(n)] = RND.choice(["ann.lee@mail.example.org", "10.20.30.40", "4111 1111 1111 1111", "+44 20 7946 0958", "1234567", "v1.2"])
    return " ".join(out)


@pytest.fixture(scope="module")
def model():
    windows = [w for _ in range(250) for w in P.training_windows(text(), 8, 3)]
    return P.fit(windows, steps=80)


def plain_path(model, text):
    """Best tags by the textbook recursion over the whole text."""
    scores, weight = np.zeros((len(text), P.TAGS)), np.zeros(len(text))
    share = P._blend()
    for at in range(0, max(1, len(text) - P.WINDOW + P.STRIDE), P.STRIDE):
        c = P.codes(text[at:at + P.WINDOW])
        x = np.pad(c, (0, P.WINDOW - len(c)), constant_values=129)[None]
        h = np.concatenate([model._run(x, "f")[0], model._run(x, "b")[0]], axis=2)
        e = (h @ model.w["o"] + model.w["ob"])[:, 0]
        for t in range(len(c)):
            scores[at + t] += e[t] * share[t]
            weight[at + t] += share[t]
    scores /= weight[:, None]
    trans = model.w["t"] + P.LEGAL
    best, back = scores[0] + P.START, []
    for e in scores[1:]:
        step = [[best[a] + trans[a][b] for a in range(P.TAGS)] for b in range(P.TAGS)]
        back.append([int(np.argmax(s)) for s in step])
        best = np.array([max(s) for s in step]) + e
    tags = [int(np.argmax(best))]
    for row in reversed(back):
        tags.append(row[tags[-1]])
    return tags[::-1]


def test_decoding_equals_a_plain_search_over_whole_texts(model):
    texts = [text(n) for n in (1, 3, 20, 40, 90)] + ["7" * 300, "a@b.c" * 60, "+1 22 " * 50, "x", "10.20.30.40"]
    got = P.decode(model, texts)
    assert any(got)
    for t, spans in zip(texts, got, strict=True):
        assert spans == P._spans(np.array(plain_path(model, t))), t


def test_every_character_is_read(model):
    e, begin = P.scores(model, ["no such thing here " * 20, "", "x"])
    assert begin.tolist() == [0, 380, 380, 381] and np.isfinite(e).all()


def test_spans_need_no_digit_or_at_sign():
    shown = [(f"{a} ann (at) mail (dot) org {b}", [(0, len(a) + 1, len(a) + 26)])
             for a, b in ((" ".join(RND.choices(WORDS, k=RND.randint(1, 6))), " ".join(RND.choices(WORDS, k=4))) for _ in range(200))]
    found = P.find(["visit or write ann (at) mail (dot) org the note of code"], P.fit(shown, steps=120))
    assert any(k == 0 for k, _, _ in found[0][1]) and not found[0][0]


def test_base_spans_stay(model):
    for base, every in P.find([text() for _ in range(30)], model):
        assert set(base) <= set(every)
        assert every == sorted(every)


def test_training_windows_hold_the_parts_of_spans():
    got = P.training_windows("x " * 50 + "ann.lee@mail.example.org" + " y" * 200, 8, 2)
    assert [len(s) for _, s in got] == [1, 1, 0, 0]
    assert got[0][1] == [(0, 100, 124)] and got[1][1] == [(0, 0, 20)]
    assert P.training_windows("", 8, 2) == [("", [])]


def test_long_runs_take_linear_time(model):
    start = time.time()
    for t in ("7" * 200_000, "1." * 50_000, "@" * 50_000, "a" * 200_000):
        P.find([t], model)
    assert time.time() - start < 60


def test_without_spans_there_is_no_tagger(spark, make_docs):
    assert P.train(make_docs([(1, "no personal data 5"), (2, None)])) is None
    rows = P.query(make_docs([(1, "nothing"), (1, "nothing"), (None, None)])).collect()
    assert [r["spans"] for r in rows] == ["", "", ""]
