"""What a watermark drops, counted, so that a stream's windows and their late
rows add up to the batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from corpuslab.operators.panes import micros


def write_late_counts(
    log: DataFrame, keys: list[str | Column], span: str, delay: str, path: str, checkpoint: str
) -> StreamingQuery:
    """Count the rows of a stream that come after their window of ``span`` has
    been closed by a watermark of ``delay``, per window and ``keys``, into
    ``path``/late with a folder for each micro-batch.

    A windowed aggregate drops by the watermark of the micro-batch before, so
    the newest time up to two micro-batches before is what counts; it is written
    for the following ones. The aggregate must read the source in the same
    micro-batches, one after the other. A repeated batch replaces its folders,
    so nothing is counted twice.
    """
    spark = log.sparkSession

    def newest_of(number: int) -> int | None:
        return spark.read.parquet(f"{path}/newest/{number}").first()["us"] if number >= 0 else None

    def count(batch: DataFrame, number: int) -> None:
        newest, older = newest_of(number - 1), newest_of(number - 2)
        # Watermarks are whole milliseconds.
        closed = None if older is None else (older // 1000 * 1000) - micros(delay)
        window = F.window("timestamp", span)
        late = F.unix_micros("window.end") <= F.lit(closed).cast("bigint")
        counted = batch.withColumn("window", window).filter(late).groupBy("window", *keys).agg(F.count(F.lit(1)).alias("late"))
        counted.write.mode("overwrite").parquet(f"{path}/late/batch={number}")
        seen = batch.agg(F.greatest(F.max(F.unix_micros("timestamp")), F.lit(newest).cast("bigint")).alias("us"))
        seen.coalesce(1).write.mode("overwrite").parquet(f"{path}/newest/{number}")

    return log.writeStream.foreachBatch(count).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def late_counts(spark, path: str, keys: list[str]) -> DataFrame:
    """Late rows by window and ``keys``, over all micro-batches."""
    return spark.read.parquet(f"{path}/late").groupBy("window", *keys).agg(F.sum("late").alias("late"))


def accounted(batch: DataFrame, stream: DataFrame, late: DataFrame, keys: list[str], count: str) -> DataFrame:
    """Per window and ``keys``: rows of the batch, of the stream, and late ones.
    Windows that the stream has not closed yet have no stream rows."""
    sides = [
        df.select("window", *keys, *[(F.col(c) if c == name else F.lit(0).cast("bigint")).alias(name) for name in ("all", "streamed", "late")])
        for df, c in (
            (batch.withColumnRenamed(count, "all"), "all"),
            (stream.withColumnRenamed(count, "streamed"), "streamed"),
            (late, "late"),
        )
    ]
    both = sides[0].unionByName(sides[1]).unionByName(sides[2])
    return both.groupBy("window", *keys).agg(*[F.sum(c).alias(c) for c in ("all", "streamed", "late")])
