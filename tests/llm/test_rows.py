"""Rows by place, and base patterns on long runs."""
import random
import re
import time

from firmo.llm import pii, rows
from firmo.llm.common import written


def test_marked_rows_go_and_others_stay(spark, make_docs, no_docs):
    docs = written(make_docs([(i, f"text {i}") for i in range(500)]).repartition(5), "rows-test")
    placed, file, at = rows.placed(docs)
    marks = placed.where("doc_id % 7 = 0").selectExpr(f"{file} AS file", f"{at} AS at")
    left = rows.apply_marks(docs, rows.write_marks(marks), rows.drop)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect()) == [i for i in range(500) if i % 7]
    none = rows.apply_marks(docs, rows.write_marks(marks.where("1 = 0")), rows.drop)
    assert none.count() == 500


def test_other_tables_are_written_first(spark, make_docs):
    docs = make_docs([(1, "a"), (2, "b")])
    on = rows.on_files(docs)
    assert on is not docs and rows.on_files(on) is on
    clash = written(docs.withColumnRenamed("extra col", "row_file"), "clash")
    assert rows.placed(clash)[1] == "_row_file"


def test_addresses_in_long_runs_of_digits():
    began = time.time()
    assert pii.base_spans("0" * 5000 + ".1.2.3") == [(1, 0, 5006)]
    assert pii.base_spans("9" * 5000 + ".1.2.3") == []
    pii.base_spans("1" * 1_000_000)
    pii.base_spans("1.1." * 200_000)
    assert time.time() - began < 20
    plain, rnd = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), random.Random(1)
    for _ in range(20_000):
        text = "".join(rnd.choice("12..a") for _ in range(rnd.randint(0, 24)))
        assert [m.span() for m in plain.finditer(text)] == [m.span() for m in pii.IP.finditer(text)]
