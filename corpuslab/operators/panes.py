"""Sliding windows over counts without copying events.

An event enters one pane, as wide as the greatest common divisor of window and
slide. The counts of a window are the difference of two running sums over the
panes: the sum up to its last pane, and the sum before its first. Every window
with an event is made once, by the first pane in it that has events.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from .scan import Running, running

UNITS = {"microsecond": 1, "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000}


def micros(span: str) -> int:
    """Microseconds of a span such as "15 seconds"."""
    count, unit = span.split()
    return int(count) * UNITS[unit.removesuffix("s")]


def pane_width(span: str, slide: str) -> int:
    if micros(slide) > micros(span):
        raise ValueError("a slide is at most as long as its window")
    return math.gcd(micros(span), micros(slide))


def pane_of(timestamp: str, span: str, slide: str) -> Column:
    """The window column of the pane that a row falls into."""
    return F.window(timestamp, f"{pane_width(span, slide)} microseconds")


def sliding(panes: DataFrame, keys: list[str], counts: list[str], span: str, slide: str, group_rows: int | None = None) -> DataFrame:
    """``keys``, window (start and end) and ``counts`` of all windows with an
    event. ``panes`` has one row per key and pane, with the pane as ``window``
    and whole numbers as ``counts``.

    A stream adds panes up per window instead; the copies are of panes then.
    """
    if panes.isStreaming:
        window = F.window(F.window_time("window"), span, slide).alias("window")
        return panes.groupBy(window, *keys).agg(*[F.sum(c).alias(c) for c in counts])
    width, step, pane = micros(span), micros(slide), pane_width(span, slide)
    at = panes.select(*keys, F.unix_micros("window.start").alias("at"), *counts)
    sums = running(
        at,
        keys,
        ["at"],
        [Running("_before", "previous", F.col("at")), *[Running(f"_upto_{c}", "sum", F.col(c).cast("bigint")) for c in counts]],
        group_rows,
    )
    # Windows whose first pane with events is this one start after the pane before, and not a window earlier.
    after = F.greatest(F.coalesce("_before", F.col("at") - width), F.col("at") - width)
    first, last = (F.floor(after / step) + 1) * step, F.floor(F.col("at") / step) * step
    starts = F.when(first <= last, F.sequence(first, last, F.lit(step))).otherwise(F.array().cast("array<bigint>"))
    probes = sums.select(
        *keys,
        F.explode(starts).alias("_start"),
        *[(F.col(f"_upto_{c}") - F.col(c)).alias(f"_base_{c}") for c in counts],
    )
    nothing = F.lit(None).cast("bigint")
    rows = sums.select(
        *keys,
        "at",
        nothing.alias("_start"),
        *[nothing.alias(f"_base_{c}") for c in counts],
        *[F.col(f"_upto_{c}") for c in counts],
    ).unionByName(
        probes.select(
            *keys,
            (F.col("_start") + width - pane).alias("at"),
            "_start",
            *[f"_base_{c}" for c in counts],
            *[nothing.alias(f"_upto_{c}") for c in counts],
        )
    )
    # A probe follows the pane at its place: null starts come first.
    reached = running(rows, keys, ["at", "_start"], [Running(f"_to_{c}", "last", F.col(f"_upto_{c}")) for c in counts], group_rows)
    start = F.col("_start")
    window = F.struct(F.timestamp_micros(start).alias("start"), F.timestamp_micros(start + width).alias("end"))
    return reached.filter(start.isNotNull()).select(
        window.alias("window"), *keys, *[(F.col(f"_to_{c}") - F.col(f"_base_{c}")).alias(c) for c in counts]
    )
