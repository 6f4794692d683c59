import pytest

from firmo.llm.common import ship


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)
    spark.conf.set("spark.sql.shuffle.partitions", "4")


DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, key string, `extra col` string"


@pytest.fixture(scope="session")
def make_docs(spark):
    """documents with clashing extra columns, from (doc_id, text) pairs."""
    def make(rows):
        return spark.createDataFrame([(i, t, "en", None, None if t is None else len(t), 0.5, "k", None) for i, t in rows], DOCS)
    return make


@pytest.fixture(scope="session")
def edge_docs(make_docs):
    """Nulls, empty and very long texts, ties and repeated rows."""
    long = " ".join(f"word{i % 977}x{i % 31}" for i in range(30_000))
    return make_docs([(1, None), (2, ""), (3, "   \n\t "), (4, "the same words in a row here"), (5, "The same, words in a ROW here!"),
                      (5, "The same, words in a ROW here!"), (6, long), (7, "x" * 5000), (None, "no id at all but some words"), (8, "é ß 中文 😀 <|endoftext|>")])


@pytest.fixture(scope="session")
def no_docs(make_docs):
    return make_docs([])
