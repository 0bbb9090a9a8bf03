"""Corpus statistics."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, Observation, functions as F

from corpuslab.functions.arrays import rows_of
from corpuslab.functions.numbers import exact_decimals
from corpuslab.session import via_table

from .scan import Running, running
from .skew import join_keys, small_side

ACCURACY = 10_000
#: Fixed value: the key of documents without a rating.
NO_RATING = "None"


def record_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("records"))


def cleaning_stats(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.avg("word_count").alias("avg_words"),
        F.max("word_count").alias("max_words"),
    )


def word_frequencies(df: DataFrame, words: str = "filtered_words") -> DataFrame:
    return rows_of(df, [], words, "word").groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def top_words(df: DataFrame, k: int = 50, words: str = "filtered_words") -> DataFrame:
    """The ``k`` most frequent words, equal counts in word order."""
    return word_frequencies(df, words).orderBy(F.desc("count"), "word").limit(k)


def length_stats(df: DataFrame, accuracy: int = ACCURACY) -> DataFrame:
    length = F.col("word_count")
    return df.agg(
        F.count(F.lit(1)).alias("total_docs"),
        F.avg(length).alias("avg_doc_length"),
        F.stddev_samp(length).alias("std_doc_length"),
        F.percentile_approx(length, 0.5, accuracy).alias("median_doc_length"),
        F.percentile_approx(length, 0.95, accuracy).alias("p95_doc_length"),
        F.sum(length).alias("total_words"),
    )


def rating_distribution(df: DataFrame) -> DataFrame:
    return df.groupBy("rating").agg(F.count(F.lit(1)).alias("count")).orderBy("rating")


def corpus_statistics(df: DataFrame, k: int = 20) -> DataFrame:
    """One row with the statistics document of a feature table.

    Words, lengths and ratings are three aggregates of ``df``; hand in a
    written table, of which they read only filtered_words, word_count, rating.
    """
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("count")).alias("o"), "word", "count")))
    listed = F.transform(ordered, lambda s: F.struct(s["word"].alias("word"), s["count"].alias("count")))
    top = top_words(df, k).agg(listed.alias("w")).scalar()
    ratings = (
        df.groupBy(F.coalesce(F.col("rating").cast("string"), F.lit(NO_RATING)).alias("rating"))
        .agg(F.count(F.lit(1)).alias("count"))
        .agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("rating", "count")))).alias("r"))
    )
    return length_stats(df).select(
        F.col("total_docs").alias("total_documents"),
        "total_words",
        F.round("avg_doc_length", 1).alias("avg_document_length"),
        F.round("std_doc_length", 1).alias("std_document_length"),
        F.col("median_doc_length").alias("median_document_length"),
        F.col("p95_doc_length").alias("p95_document_length"),
        top.alias(f"top_{k}_words"),
        ratings.scalar().alias("rating_distribution"),
    )


def run_metrics(df: DataFrame, mode: str = "batch") -> DataFrame:
    """Run ``df`` to its end and report rows, partitions, seconds and rows per second."""
    seen = Observation("run_metrics")
    started = time.monotonic()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.format("noop").mode("overwrite").save()
    seconds = time.monotonic() - started
    rows = seen.get["rows"]
    return df.sparkSession.createDataFrame(
        [(rows, df.rdd.getNumPartitions(), seconds, rows / seconds if seconds > 0 else 0.0, mode)],
        "input_records long, spark_partitions int, total_runtime_seconds double, "
        "throughput_docs_per_second double, mode string",
    )


def text_lengths(df: DataFrame, text: str = "text") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_abstracts"), F.avg(F.length(text)).alias("avg_length"))


def histogram(df: DataFrame, by: list[str], value: str, bins: int) -> DataFrame:
    """Equal-width bins between the smallest and largest value of each group;
    the last bin is closed. Every bin has a row; a group of one value has one."""
    known = df.filter(F.col(value).isNotNull()).select(*by, value)
    ends = known.groupBy(*by).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    if by:
        placed = join_keys(known, small_side(ends), by)
    else:
        low, high = ends.select("_lo").scalar(), ends.select("_hi").scalar()
        placed = known.withColumns({"_lo": low, "_hi": high})
    width = (F.col("_hi") - F.col("_lo")) / bins
    index = F.when(width > 0, F.least(F.floor((F.col(value) - F.col("_lo")) / width), F.lit(bins - 1))).otherwise(0)
    counted = placed.groupBy(*by, "_lo", "_hi", index.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    found = counted.groupBy(*by, "_lo", "_hi").agg(F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("_n"))
    every = found.withColumn("bin", F.explode(F.sequence(F.lit(0), F.when(width > 0, bins - 1).otherwise(0))))
    n = F.coalesce(F.try_element_at("_n", F.col("bin")), F.lit(0)).alias("n")
    return every.select(*by, "bin", (F.col("_lo") + width * F.col("bin")).alias("low"), n)


def rolling_window(rows: int) -> int:
    return max(rows // 20, 5)


def rolling_mean(
    df: DataFrame, order: str, values: list[str], window: int | None = None, group_rows: int | None = None
) -> DataFrame:
    """Mean over the last ``window`` rows by ``order``, null until that many exist.

    A frame this wide is not re-added for every row: the mean is the difference
    of two exact prefix sums, found by joining row i with row i - window.
    """
    if window is None:
        window = rolling_window(df.count())
    exact = exact_decimals(df, values)
    prefix = running(
        df.select(order, *values),
        [],
        [order],
        [Running("_i", "sum", F.lit(1).cast("bigint"))]
        + [Running(f"_s_{v}", "sum", F.coalesce(c, F.lit(0))) for v, c in exact.items()],
        group_rows,
    )
    # Read by both sides of the join.
    prefix = via_table(prefix, "prefix-sums")
    earlier = prefix.select(
        (F.col("_i") + window).alias("_i"), *[F.col(f"_s_{v}").alias(f"_e_{v}") for v in values]
    )
    joined = prefix.join(earlier, "_i", "left")

    def mean(v: str) -> Column:
        total = F.col(f"_s_{v}") - F.coalesce(F.col(f"_e_{v}"), F.lit(0))
        return F.when(F.col("_i") >= window, total.cast("double") / window)

    return joined.select(order, *values, *[mean(v).alias(f"{v}_rolling") for v in values])
