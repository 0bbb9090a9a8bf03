"""Labelling job: predict, decode, filter, write silver labels and a report."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpuslab.operators.labelling import (
    CONFIDENCE_THRESHOLD,
    Predictor,
    decode_spans,
    label_report,
    predict_tokens,
    silver_labels,
)
from corpuslab.session import scratch_tables, via_table
from corpuslab.sources.corpus import read_abstracts
from corpuslab.sources.sinks import SILVER_SOURCE, write_silver_labels


def run(
    spark: SparkSession,
    source: str,
    output: str,
    predictor_factory: Callable[[], Predictor],
    max_docs: int | None = None,
    threshold: float = CONFIDENCE_THRESHOLD,
    source_name: str = SILVER_SOURCE,
) -> DataFrame:
    """Label the abstracts (pmid, text) under ``source``; return the report row.

    The model runs once per text: its tokens are written before they are used
    for both the labels and the report. They are deleted at the end.
    """
    started = time.monotonic()
    texts = read_abstracts(spark, source, max_docs)
    labelled = predict_tokens(texts.select(F.col("pmid").alias("doc_id"), "text"), predictor_factory)
    with scratch_tables():
        decoded = decode_spans(via_table(labelled, "tokens"))
        write_silver_labels(silver_labels(decoded, threshold), f"{output}/labels", source_name)
        totals = label_report(decoded, threshold)
        report = spark.createDataFrame(totals.collect(), totals.schema)  # one row
    seconds = time.monotonic() - started
    return report.withColumns(
        {
            "runtime_seconds": F.lit(round(seconds, 1)),
            "throughput_docs_per_sec": F.round(F.col("total_abstracts") / seconds, 1),
        }
    )
