"""Toxicity and quality: held-out accuracy, and texts alone decide."""
import random

import pytest

from firmo.llm import quality, toxicity
from firmo.llm.common import remainder

RND = random.Random(3)
WORDS = [f"{a}{b}" for a in "bcdfglmnprst" for b in ("an", "er", "ion", "ou", "ist")]


def sentence(n=8):
    return " ".join(RND.choice(WORDS) for _ in range(n)).capitalize() + "."


@pytest.fixture(scope="module")
def marked(spark, make_docs):
    docs, labels = [], []
    for i in range(600):
        text = [sentence() for _ in range(RND.randint(1, 12))]
        toxic = i % 5 == 0
        if toxic:
            text[RND.randrange(len(text))] = f"{sentence(3)} vermin {sentence(2)}"
        good = i % 3 != 0
        body = " ".join(text)
        docs.append((i, body if good else body.upper().replace(" ", "!! ")))
        labels.append((i, int(good), int(toxic)))
    return make_docs(docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def accuracy(out, labels, column):
    rows = out.join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 50
    return sum(r["predicted"] == r[column] for r in rows) / len(rows)


def test_toxicity_of_held_out_documents(marked):
    docs, labels = marked
    out = toxicity.query(docs, labels)
    assert accuracy(out, labels, "toxic") > 0.95
    assert out.where("score < 0 or score > 1 or isnan(score)").count() == 0


def test_offending_sentences_are_located(marked):
    docs, labels = marked
    model = toxicity.train(docs, labels)
    found = toxicity.locate(docs, model).collect()
    assert len(found) > 60
    assert sum("vermin" in r["sentence"].lower() for r in found) / len(found) > 0.9


def test_quality_of_held_out_documents(marked):
    docs, labels = marked
    assert accuracy(quality.query(docs, labels), labels, "quality") > 0.95


def test_other_columns_do_not_matter(marked):
    docs, labels = marked
    model = toxicity.train(docs, labels)
    a = dict(toxicity.score(docs, model).select("doc_id", "score").collect())
    b = dict(toxicity.score(docs.selectExpr("doc_id", "text", "'x' as lang"), model).select("doc_id", "score").collect())
    assert a == b


@pytest.mark.parametrize("op", [toxicity, quality])
def test_edges(op, edge_docs, no_docs, marked, spark):
    _, labels = marked
    rows = op.query(edge_docs, labels).collect()
    assert len(rows) == edge_docs.count()
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert op.query(no_docs, labels).count() == 0
    none = spark.createDataFrame([], labels.schema)
    assert op.query(edge_docs, none).count() == edge_docs.count()


def test_clean_rows_stay(marked, edge_docs):
    docs, labels = marked
    model = toxicity.train(docs, labels)
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() < docs.count()
    assert toxicity.keep_clean(edge_docs, model).count() == edge_docs.count()


def test_split_is_crc32_of_the_text(spark):
    import zlib
    rows = spark.range(50).select("id", remainder("id", 5).alias("r")).collect()
    assert all(r["r"] == zlib.crc32(str(r["id"]).encode()) % 5 for r in rows)


def test_long_rows_leave_the_sample_its_rows():
    from firmo.llm.common import fitting
    rows = [(0, 900), (1, 5000)] + [(i, 10) for i in range(2, 60)]
    assert sorted(fitting(rows, 1000)) == list(range(2, 60))
    assert fitting([(1, 900), (2, 200), (3, 50)], 1000) == [1, 3]
    assert fitting([(1, 3000), (2, 2000)], 1000) == [2] and fitting([], 1000) == []


def test_a_long_document_does_not_empty_the_sample(spark, make_docs):
    from firmo.llm.common import labelled_sample
    docs = make_docs([(i, "x" * 5000 if i % 5 == 0 else f"short {i}") for i in range(50)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id long, toxic int")
    got = {r["doc_id"] for r in labelled_sample(docs, labels, "toxic", 7, 99, 100, 4000).collect()}
    assert got == {i for i in range(50) if i % 5}
