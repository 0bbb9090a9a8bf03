"""Reading, normalising and growing a corpus."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpuslab.operators.ranks import first_n

LAYOUTS = {
    # marker column: (doc_id, text, rating, source)
    "review_body": ("review_id", "review_body", "star_rating", "product_title"),
    "content": (None, "content", "label", "title"),
}


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def normalize_schema(df: DataFrame) -> DataFrame:
    """Bring a review or content layout to doc_id, text, rating, source.

    The content layout has no id; it gets the SHA-256 of its text, which is the
    same on every run (equal texts share an id). A frame that already has
    ``text`` passes unchanged.
    """
    for marker, (doc_id, text, rating, source) in LAYOUTS.items():
        if marker in df.columns:
            identity = F.sha2(F.col(text), 256) if doc_id is None else F.col(doc_id)
            return df.select(
                identity.alias("doc_id"),
                F.col(text).alias("text"),
                F.col(rating).alias("rating"),
                F.col(source).alias("source"),
            )
    if "text" not in df.columns:
        raise ValueError(f"unknown corpus layout with columns {df.columns}")
    return df


def read_abstracts(spark: SparkSession, path: str, max_docs: int | None = None, order: str = "pmid") -> DataFrame:
    df = spark.read.parquet(path)
    return df if max_docs is None else first_n(df, order, max_docs)


def union_ids(frames: list[DataFrame], column: str = "doc_id") -> DataFrame:
    """Distinct ids found by any of several searches."""
    return reduce(DataFrame.unionByName, [f.select(column) for f in frames]).distinct()


def sample_docs(
    df: DataFrame, fraction: float, seed: int = 42, by: str | None = None, fast: bool = False
) -> DataFrame:
    """Bernoulli sample. With ``by`` the draw depends on that column alone, so
    it does not change with the partitioning: on the first 32 bits of a
    SHA-256, which any engine can repeat, or ``fast`` on an XXH64."""
    if by is None:
        return df.sample(fraction, seed)
    if fast:
        steps = 1_000_000
        return df.filter(F.pmod(F.xxhash64(F.col(by), F.lit(seed)), F.lit(steps)) < int(fraction * steps))
    digest = F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col(by).cast("string")), 256)
    limit = int(fraction * 2**32)
    return df if limit >= 2**32 else df.filter(F.substring(digest, 1, 8) < f"{limit:08x}")


def spread(df: DataFrame, minimum: int) -> DataFrame:
    """At least ``minimum`` partitions; an input that has them is not shuffled."""
    return df if df.rdd.getNumPartitions() >= minimum else df.repartition(minimum)


# The two edits of the synthetic set.
APPENDED = " Follow-up appointment scheduled."
PREFIXED = "Additional notes: "


def expand_corpus(df: DataFrame, multiplier: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document ``multiplier`` times, with a numbered id. Copy i gets a
    sentence appended when i mod 3 is 0 and a prefix when it is 1."""
    copies = df.withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(multiplier - 1))))

    def edited(value: Column) -> Column:
        kind = F.pmod("_i", F.lit(3))
        return (
            F.when(kind == 0, F.concat(value, F.lit(APPENDED)))
            .when(kind == 1, F.concat(F.lit(PREFIXED), value))
            .otherwise(value)
        )

    return copies.withColumns(
        {doc_id: F.format_string("%s_v%03d", F.col(doc_id), F.col("_i")), text: edited(F.col(text))}
    ).drop("_i")
