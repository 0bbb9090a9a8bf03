"""Corpus job: read, clean, extract features, compute statistics, write both.

usage: python -m corpuslab.plans.corpus_run --input PATH --output PATH [--sample F] [--partitions N] [--local]
"""

from __future__ import annotations

import argparse
import time

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpuslab.functions.text import has_text
from corpuslab.operators.cleaning import clean_text
from corpuslab.operators.corpusstats import corpus_statistics
from corpuslab.operators.features import extract_features
from corpuslab.session import build_session, scratch_tables
from corpuslab.sources.corpus import normalize_schema, read_corpus, sample_docs, spread
from corpuslab.sources.sinks import write_features, write_stats


def ingest(spark: SparkSession, path: str, sample: float | None = None, partitions: int | None = None) -> DataFrame:
    df = read_corpus(spark, path)
    if sample:
        df = sample_docs(df, sample)
    # Filtered before it is spread, so that dropped texts are not shuffled.
    df = normalize_schema(df).filter(has_text(F.col("text")))
    return spread(df, partitions) if partitions else df


def run(
    spark: SparkSession, source: str, output: str, sample: float | None = None, partitions: int | None = None
) -> DataFrame:
    """Write ``features`` and ``stats`` below ``output``; return one row of run metrics.

    Words and hashed vectors are written once for the two fits and deleted at
    the end; the statistics come from the written features, of which they need
    three columns.
    """
    started = time.monotonic()
    raw = ingest(spark, source, sample, partitions)
    with scratch_tables():
        vectors, _ = extract_features(clean_text(raw, keep_words=True))
        write_features(vectors, f"{output}/features")
    features = spark.read.parquet(f"{output}/features")
    write_stats(corpus_statistics(features), f"{output}/stats")
    records = raw.count()
    seconds = time.monotonic() - started
    return spark.createDataFrame(
        [(records, features.count(), round(seconds, 1), round(records / seconds, 1))],
        "input_records long, clean_records long, total_runtime_seconds double, throughput_docs_per_second double",
    )


def main() -> None:
    args = argparse.ArgumentParser()
    args.add_argument("--input", required=True)
    args.add_argument("--output", required=True)
    args.add_argument("--sample", type=float)
    args.add_argument("--partitions", type=int)
    args.add_argument("--local", action="store_true")
    options = args.parse_args()
    spark = build_session("corpus-run", "local[*]" if options.local else None)
    run(spark, options.input, options.output, options.sample, options.partitions).show(truncate=False)


if __name__ == "__main__":
    main()
