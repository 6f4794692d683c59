"""A training-corpus pipeline over ``documents``: five stages, each of which
works on all rows its predecessor kept.

Each function takes (spark, docs, sf_dir) and returns a DataFrame; ``run``
writes it as Parquet to the shared folder and reads it again as the next one's
docs.  All stages but the last return the columns of documents.

  toxicity         rows whose noisy-or score reaches 0.5 go (learned from labels)
  near_duplicates  of each group linked by a Jaccard similarity of 0.8 or more
                   over runs of five words the smallest doc_id stays
  decontamination  rows of which a twentieth or more is hit by 13-word windows of
                   benchmark go; shorter hits are cut out of the text
  pii              personal data is replaced by its kind
  bpe              token counts and digests of ids and of the decoded text

Null and empty texts pass all stages.  Extra columns pass all but the last."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from firmo.llm import bpe, decontaminate, near_duplicates, pii
from firmo.llm import toxicity as tox
from firmo.llm.common import ship, written

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = ship(spark).read.parquet(f"{sf_dir}/labels.parquet")
    return tox.keep_clean(docs, tox.train(docs, labels))


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return near_duplicates.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, ship(spark).read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return pii.redact(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return bpe.round_trip(docs, VOCABULARY)


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicate), ("decontamination", decontamination),
          ("pii", personal_data), ("bpe", encoding)]

#: a learned score and BPE have no SQL; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
