"""Trace spans: time covered by children, and a gauge on a dense time grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .scan import Running, running

GRID_CHUNK = 10_000


def covered_time(spans: DataFrame, group_rows: int | None = None) -> DataFrame:
    """Microseconds of each span (trace_id, span_id) that its children cover:
    the length of the union of their intervals, as far as they lie inside it.

    Children are taken by start; each adds what lies beyond the furthest end
    before it. Parents with very many children are scanned in blocks.
    """
    parents = spans.select("trace_id", "span_id", F.col("start_us").alias("_from"), F.col("end_us").alias("_to"))
    children = spans.filter(F.col("parent_id").isNotNull()).select(
        "trace_id", F.col("parent_id").alias("span_id"), F.col("span_id").alias("_child"), "start_us", "end_us"
    )
    inside = (
        children.join(parents, ["trace_id", "span_id"])
        .select(
            "trace_id",
            "span_id",
            "_child",
            F.greatest("start_us", "_from").alias("start_us"),
            F.least("end_us", "_to").alias("end_us"),
        )
        .filter(F.col("end_us") > F.col("start_us"))
    )
    order = ["start_us", "end_us", "_child"]
    reached = running(
        inside, ["trace_id", "span_id"], order, [Running("_reached", "max_before", F.col("end_us"))], group_rows
    )
    new = F.col("end_us") - F.greatest("start_us", F.coalesce("_reached", F.col("start_us")))
    return reached.groupBy("trace_id", "span_id").agg(F.sum(F.greatest(new, F.lit(0))).alias("covered_us"))


def stage_durations(spans: DataFrame, group_rows: int | None = None) -> DataFrame:
    """Per span name: number, mean duration and mean time not spent in child
    spans. ``spans`` has trace_id, span_id, parent_id, name, start_us, end_us;
    children may overlap each other, and may outlast their parent."""
    timed = spans.join(covered_time(spans, group_rows), ["trace_id", "span_id"], "left")
    whole = F.col("end_us") - F.col("start_us")
    own = whole - F.coalesce("covered_us", F.lit(0))
    return timed.groupBy("name").agg(
        F.count(F.lit(1)).alias("spans"),
        (F.avg(whole) / 1000).alias("mean_ms"),
        (F.avg(own) / 1000).alias("mean_self_ms"),
    )


def steps_between(first: Column, last: Column, step: int) -> Column:
    """An array of arrays with first, first + step, ... up to last, each inner
    array of at most ``GRID_CHUNK`` steps, so that a long gap is no long value."""
    wide = step * GRID_CHUNK
    return F.transform(
        F.sequence(first, last, F.lit(wide)),
        lambda at: F.sequence(at, F.least(at + wide - step, last), F.lit(step)),
    )


def on_grid(gauge: DataFrame, at: str, value: str, zero: list[str], step: int, group_rows: int | None = None) -> DataFrame:
    """``gauge`` (one row per ``at``, a multiple of ``step``) with a row for every
    step between its first and last: ``value`` is carried forward, columns in
    ``zero`` are 0 there."""
    known = running(
        gauge,
        [],
        [at],
        [Running("_at", "previous", F.col(at)), Running("_value", "previous", F.col(value))],
        group_rows,
    )
    first = F.coalesce(F.col("_at") + step, F.col(at))
    chunks = known.withColumn("_chunk", F.explode(steps_between(first, F.col(at), step)))
    rows = chunks.withColumn("_step", F.explode("_chunk"))
    own = F.col("_step") == F.col(at)
    return rows.select(
        F.col("_step").alias(at),
        *[F.when(own, F.col(c)).otherwise(F.lit(0).cast(gauge.schema[c].dataType)).alias(c) for c in zero],
        F.when(own, F.col(value)).otherwise(F.col("_value")).alias(value),
    )
