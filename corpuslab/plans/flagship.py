"""From raw documents to the most frequent words of each rating."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from corpuslab.catalog.tables import features
from corpuslab.functions.arrays import rows_of


def top_words_per_rating(spark: SparkSession, sf: str, k: int = 10) -> DataFrame:
    docs = features(spark, sf, rated=True).select("rating", "filtered_words")
    counts = (
        rows_of(docs, ["rating"], "filtered_words", "word")
        .groupBy("rating", "word")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    best = Window.partitionBy("rating").orderBy(F.desc("count"), "word")
    return counts.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
