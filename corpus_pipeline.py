"""A training-data pipeline over ``documents``: five operators of
``corpuslab.llm``, each reading what the one before wrote.

Documents that a quality rule rejects go; of near copies the one with the
smallest doc_id stays; documents that leak a benchmark item go; personal data is
replaced by the name of its kind; what is left is encoded, and decoded again
for comparison. Each stage takes null, empty and very long texts, repeated
rows, empty tables and further columns as its operator says.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from corpuslab.llm import op02_byte_bpe, op04_simhash, op08_quality_rules, op09_decontamination, op10_pii
from corpuslab.llm.common import documents
from corpuslab.session import via_table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op08_quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op04_simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op09_decontamination.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op10_pii.redacted(docs, op10_pii.train(docs))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return op02_byte_bpe.encoded_digests(docs, vocabulary, public_tokenizers.PATTERN, keep_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("byte_bpe", byte_bpe),
]

#: Fingerprints, models and token ids are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = via_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
