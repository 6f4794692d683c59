"""Registered queries against their SQL, and the shape of all of them."""
import pytest

import __spark_entry__ as E
from firmo.llm import queries as Q
from oracle_harness import compare, duck

SF = "/root/testdata/sf0.001"


def test_each_operator_has_one_query():
    names = sorted(Q.QUERIES)
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert set(names) | {"pipeline"} <= set(E.queries())
    assert set(Q.SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(Q.SQL))
def test_against_sql(spark, name):
    r = compare(Q.QUERIES[name](spark, SF), duck(SF), Q.SQL[name])
    assert r["cols_ok"] and r["hash_ok"], r


@pytest.mark.parametrize("name, columns", [
    ("op2_toxicity", ["doc_id", "held_out", "score", "predicted"]),
    ("op3_quality_classifier", ["doc_id", "held_out", "score", "predicted"]),
    ("op5_license_scan", ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]),
    ("op6_bpe", ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]),
    ("op7_pii", ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]),
    ("op12_token_alignment", ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]),
    ("op8_token_store", ["doc_id", "start", "n_tokens", "ids_crc32"]),
])
def test_every_document_has_its_row(spark, name, columns):
    out = Q.QUERIES[name](spark, SF)
    assert out.columns[:len(columns)] == columns
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert sorted(r[0] for r in out.select("doc_id").collect()) == sorted(r[0] for r in docs.select("doc_id").collect())
