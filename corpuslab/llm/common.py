"""What the operators of this subpackage share: reading documents and running
functions over Arrow batches of texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

BATCH_ROWS = 500
ROWS_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


def texts(docs: DataFrame, *keep: str | Column) -> DataFrame:
    """doc_id, the text (null: empty) and ``keep``; other columns are not read."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"), *keep)


def sampled_texts(docs: DataFrame, rows: int) -> DataFrame:
    """Different texts (null: empty) of about ``rows`` documents, at most, with
    the number of their copies as ``copies``. A hash of the text chooses, so the
    sample does not depend on partitions, and copies are one row."""
    share = min(1.0, rows / max(1, docs.count()))
    key = F.xxhash64("text")
    chosen = texts(docs).select("text").filter(F.pmod(key, F.lit(1 << 30)) < int(share * (1 << 30)))
    return chosen.groupBy("text").agg(F.count(F.lit(1)).alias("copies"))


def bounded_batches(spark: SparkSession) -> None:
    """Texts may be long, so batches are kept to ``BATCH_ROWS`` rows: the
    session setting is lowered where it is larger."""
    if not 0 < int(spark.conf.get(ROWS_SETTING)) <= BATCH_ROWS:
        spark.conf.set(ROWS_SETTING, str(BATCH_ROWS))


def map_batches(df: DataFrame, make: Callable[[], Callable[[dict], Iterator[dict]]], schema: str) -> DataFrame:
    """Columns as lists in, columns as lists (or numpy or Arrow arrays) out.

    ``make`` runs once per task and returns the function for a batch, which
    yields dictionaries with the columns of ``schema``.
    """
    spark = df.sparkSession
    bounded_batches(spark)
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(spark.createDataFrame([], schema).schema)

    def run(batches):
        step = make()
        for batch in batches:
            if batch.num_rows:
                columns = dict(zip(batch.schema.names, (c.to_pylist() for c in batch.columns), strict=True))
                for out in step(columns):
                    yield as_batch(out, arrow)
        finish = getattr(step, "finish", None)
        if finish is not None:
            for out in finish():
                yield as_batch(out, arrow)

    return df.mapInArrow(run, schema)


def slices(strings: list[str], chars: int) -> Iterator[slice]:
    """Slices of at most ``chars`` characters, or of one string."""
    at, held = 0, 0
    for i, string in enumerate(strings):
        if i > at and held + len(string) > chars:
            yield slice(at, i)
            at, held = i, 0
        held += len(string)
    if at < len(strings):
        yield slice(at, len(strings))


def as_batch(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c.cast(f.type) if isinstance(c := columns[f.name], pa.Array) else pa.array(c, type=f.type) for f in schema], schema=schema
    )
