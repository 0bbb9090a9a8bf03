"""Request-log analytics on streams.

The aggregates of ``operators.requests`` run unchanged on a watermarked stream;
what differs from batch is late data, repeats and sessions that must end.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from corpuslab.operators.requests import SLA_MS

WATERMARK = "10 minutes"


def watermarked(log: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """Rows older than the newest seen minus ``delay`` no longer count."""
    return log.withWatermark("timestamp", delay)


def first_per_request(log: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """Drop repeats of a request id that come within ``delay``; rows without an
    id are all kept, and need no state."""
    marked = watermarked(log, delay)
    named = marked.filter(F.col("request_id").isNotNull()).dropDuplicatesWithinWatermark(["request_id"])
    return named.unionByName(marked.filter(F.col("request_id").isNull()))


def entities_of() -> Column:
    """Entities found by a request."""
    counts = F.map_values(F.coalesce("entity_counts", F.create_map().cast("map<string,int>")))
    return F.aggregate(counts, F.lit(0).cast("bigint"), lambda a, n: a + n)


def session_numbers(
    log: DataFrame, session: str, gap_seconds: int = 1800, delay: str = WATERMARK, limit_ms: float = SLA_MS
) -> DataFrame:
    """Per answered request, as it arrives: requests, entities, mean latency and
    share below the limit so far in its session.

    A session keeps four numbers and its last time; it ends after ``gap_seconds``
    without a request, and is forgotten once the watermark has passed that end.
    """
    rows = watermarked(log.filter(F.col("latency_ms").isNotNull()), delay).select(
        session, "timestamp", "latency_ms", entities_of().alias("entities")
    )
    key = rows.schema[session]
    out = T.StructType(
        [
            T.StructField(session, key.dataType),
            T.StructField("timestamp", T.TimestampType()),
            T.StructField("requests", T.LongType()),
            T.StructField("entities", T.LongType()),
            T.StructField("mean_latency_ms", T.DoubleType()),
            T.StructField("sla_pct", T.DoubleType()),
        ]
    )

    def advance(name: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        part = pd.concat(list(frames)).sort_values("timestamp", kind="stable")
        at = [int(t.timestamp() * 1000) for t in part["timestamp"]]
        requests, entities, total, within, last = state.get if state.exists else (0, 0, 0.0, 0, at[0])
        rows = []
        for now, stamp, latency, found in zip(at, part["timestamp"], part["latency_ms"], part["entities"], strict=True):
            if now - last > gap_seconds * 1000:
                requests, entities, total, within = 0, 0, 0.0, 0
            requests, entities, total, last = requests + 1, entities + int(found), total + latency, max(last, now)
            within += int(latency < limit_ms)
            rows.append((name[0], stamp, requests, entities, total / requests, within * 100 / requests))
        yield pd.DataFrame(rows, columns=out.names)
        state.update((requests, entities, total, within, last))
        ends = last + gap_seconds * 1000
        if ends > state.getCurrentWatermarkMs():
            state.setTimeoutTimestamp(ends)
        else:
            state.remove()

    kept = "requests long, entities long, total double, within long, last long"
    return rows.groupBy(session).applyInPandasWithState(
        advance, out, kept, "append", GroupStateTimeout.EventTimeTimeout
    )


def session_totals(log: DataFrame, session: str, gap: str = "30 minutes", delay: str = WATERMARK) -> DataFrame:
    """Requests, entities, mean latency and share below the limit per session.

    A session ends after ``gap`` without a request, which also frees its state.
    """
    answered = watermarked(log.filter(F.col("latency_ms").isNotNull()), delay)
    totals = answered.groupBy(F.session_window("timestamp", gap), session).agg(
        F.count(F.lit(1)).alias("requests"),
        F.sum(entities_of()).alias("entities"),
        F.avg("latency_ms").alias("mean_latency_ms"),
        (F.avg((F.col("latency_ms") < SLA_MS).cast("double")) * 100).alias("sla_pct"),
    )
    return totals.select(
        session,
        F.col("session_window.start").alias("session_start"),
        F.col("session_window.end").alias("session_end"),
        "requests",
        "entities",
        "mean_latency_ms",
        "sla_pct",
    )


def write_table(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append finished rows to a Parquet table until all present input is read."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
