"""The pipeline's stages on planted cases, each judged on its own input."""
import corpus_pipeline as C
import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in C.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        docs = C.written(docs, f"test-{name}")
        assert docs.columns == columns, name
        assert 0 < docs.count() <= before, name
        before = docs.count()
    out = C.STAGES[-1][1](spark, docs, SF)
    assert sorted(r[0] for r in out.select("doc_id").collect()) == sorted(r[0] for r in docs.select("doc_id").collect())
    whole = E.queries()["pipeline"](spark, SF)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, out.collect()))


def test_stages_take_edge_cases(spark, edge_docs, no_docs):
    for docs in (edge_docs, no_docs):
        n = docs.count()
        for name, stage in C.STAGES[:-1]:
            docs = C.written(stage(spark, docs, SF), f"edge-{name}")
        assert docs.count() == (n - 2 if n else 0)      # two copies go
        assert C.STAGES[-1][1](spark, docs, SF).count() == docs.count()


def test_stage_order():
    assert [n for n, _ in C.STAGES] == ["toxicity", "near_duplicates", "decontamination", "pii", "bpe"]
