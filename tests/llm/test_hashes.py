"""Span hashes, and that texts of long words are told apart."""
import numpy as np

from firmo.llm import decontaminate, near_duplicates
from firmo.llm.common import Words


def thue_morse(n):
    a = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
    return a, a.translate(str.maketrans("ab", "ba"))


def test_words_equal_modulo_a_power_of_two_are_told_apart():
    for n in (512, 1024, 4096):
        h = Words([x.encode() for x in thue_morse(n)]).hashes()
        assert h[0] != h[1], n


def test_hashes_do_not_depend_on_the_place():
    long = "x" * 200
    w = Words([f"{long} ab {long.upper()}".encode(), f"cd {long} ab".encode()])
    h = w.hashes()
    assert h[0] == h[2] == h[4] and h[1] == h[5] and len(np.unique(h)) == 3


def test_operators_tell_long_words_apart(spark, make_docs):
    a, b = thue_morse(2048)
    docs = make_docs([(1, f"one two three four {a}"), (2, f"one two three four {b}")])
    rows = near_duplicates.query(docs).orderBy("doc_id").collect()
    assert [(r["n_copies"], r["n_links"]) for r in rows] == [(1, 0), (1, 0)]
    assert near_duplicates.keep_one(docs).count() == 2
    items = spark.createDataFrame([("i", a)], "item_id string, text string")
    hits = {r["doc_id"]: r["n_hit"] for r in decontaminate.query(docs, items).collect()}
    assert hits == {1: 1, 2: 0}
