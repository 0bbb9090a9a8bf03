"""Running values over ordered rows without sending one group to one task.

A group with more than ``group_rows`` rows is cut into blocks at quantiles of
its order column. Each block is scanned on its own; block totals, which are
few, supply what the blocks before contribute. The cuts are literals in the
plan, so a lost executor recomputes exactly the same blocks.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from corpuslab.functions.arrays import chunk_literal, chunked, cuts_passed

from .skew import as_local, join_keys

GROUP_ROWS = 2_000_000
#: Blocks follow the rows up to here; cut points are part of the plan.
MAX_BLOCKS = 65_536
MAX_GROUP_BLOCKS = 16_384
MAX_HOT_GROUPS = 16_384
MAX_BROADCAST_BLOCKS = 100_000

BLOCK = "_block"
GROUP = "_group"


@dataclass(frozen=True)
class Running:
    """One running value: ``kind`` is sum, max, max_before (without the current
    row), last or previous."""

    name: str
    kind: str
    value: Column


def _position(order: str, schema: T.StructType) -> Column:
    kind = schema[order].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(F.col(order)).cast("double")
    return F.col(order).cast("double")


def _cuts(df: DataFrame, keys: list[str], order: str, group_rows: int) -> tuple[DataFrame | None, int]:
    """Chunked cut points of every oversized group, and the number of blocks."""
    where = _position(order, df.schema)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    if keys:
        # Groups beyond the largest MAX_HOT_GROUPS hold less than 1 / MAX_HOT_GROUPS of the rows each.
        large = (
            sizes.filter(F.col("n") > group_rows)
            .orderBy(F.desc("n"), *keys)
            .limit(MAX_HOT_GROUPS)
            .collect()
        )
        if not large:
            return None, 0
        most = MAX_GROUP_BLOCKS
        hot = as_local(sizes, large)
        inside = join_keys(df.select(*keys, where.alias("p")), F.broadcast(hot.drop("n")), keys, "inner")
    else:
        large, most = sizes.collect(), MAX_BLOCKS
        inside = df.select(where.alias("p"))
    wanted = {tuple(row[k] for k in keys): min(most, max(ceil(row["n"] / group_rows), 8)) for row in large}
    finest = max(wanted.values())
    fractions = [i / finest for i in range(1, finest)]
    # Cuts only balance the blocks, so an error of an eighth of a block will do, and keeps the states small.
    every = inside.groupBy(*keys).agg(F.percentile_approx("p", fractions, max(1_000, 8 * finest)).alias("cuts"))
    found = {tuple(row[k] for k in keys): row["cuts"] or [] for row in every.collect()}
    rows, blocks = [], 0
    for key, count in wanted.items():
        points = found.get(key, [])
        chosen = sorted({points[len(points) * i // count] for i in range(1, count)}) if points else []
        rows.append((*key, chunked(chosen)))
        blocks += len(chosen) + 1
    schema = T.StructType(
        [df.schema[k] for k in keys] + [T.StructField("cuts", T.ArrayType(T.ArrayType(T.DoubleType())))]
    )
    return df.sparkSession.createDataFrame(rows, schema), blocks


def add_blocks(
    df: DataFrame,
    keys: list[str],
    order: str,
    group_rows: int | None = None,
    sizing: DataFrame | None = None,
) -> tuple[DataFrame, int]:
    """``df`` with a block number that never decreases along ``order``.

    Returns the frame and the number of blocks that need a carried value; with
    0 no group is oversized and the frame is unchanged. ``sizing`` may be a
    cheaper frame with the same keys and order column.
    """
    cuts, blocks = _cuts(df if sizing is None else sizing, keys, order, group_rows or GROUP_ROWS)
    if cuts is None:
        return df, 0
    if keys:
        with_cuts = join_keys(df, F.broadcast(cuts), keys, "left")
    else:
        points = cuts.collect()[0]["cuts"]
        with_cuts = df.withColumn("cuts", chunk_literal([p for chunk in points for p in chunk]))
    passed = cuts_passed(F.col("cuts"), _position(order, df.schema), include=True)
    return with_cuts.withColumn(BLOCK, F.when(F.col("cuts").isNull(), -1).otherwise(passed)).drop("cuts"), blocks


def running(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    values: list[Running],
    group_rows: int | None = None,
    sizing: DataFrame | None = None,
) -> DataFrame:
    """``df`` with running values per ``keys`` along ``order``, current row included.

    The first order column must be a number, date or timestamp; the order
    columns together must be unique within a group.
    """
    blocked, blocks = add_blocks(df, keys, order[0], group_rows, sizing)
    within = [*keys, BLOCK] if blocks else keys
    rows = Window.partitionBy(*within).orderBy(*order)
    so_far = rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def local(v: Running) -> Column:
        if v.kind == "sum":
            return F.sum(v.value).over(so_far)
        if v.kind == "max":
            return F.max(v.value).over(so_far)
        if v.kind == "max_before":
            return F.max(v.value).over(rows.rowsBetween(Window.unboundedPreceding, -1))
        if v.kind == "last":
            return F.last(v.value, ignorenulls=True).over(so_far)
        if v.kind == "previous":
            return F.lag(F.struct(v.value.alias("v"))).over(rows)
        raise ValueError(f"unknown running value {v.kind!r}")

    scanned = blocked.select("*", *[local(v).alias(v.name) for v in values])
    if blocks:
        scanned = _add_carry(scanned, blocked, keys, order, values, blocks)
    previous = {v.name: F.col(v.name)["v"] for v in values if v.kind == "previous"}
    return scanned.withColumns(previous).drop(BLOCK) if previous else scanned.drop(BLOCK)


def _add_carry(
    scanned: DataFrame,
    blocked: DataFrame,
    keys: list[str],
    order: list[str],
    values: list[Running],
    blocks: int,
) -> DataFrame:
    at = F.struct(*order)

    def total(v: Running) -> Column:
        if v.kind == "sum":
            return F.sum(v.value)
        if v.kind in ("max", "max_before"):
            return F.max(v.value)
        if v.kind == "last":
            return F.max_by(v.value, F.when(v.value.isNotNull(), at))
        return F.max_by(F.struct(v.value.alias("v")), at)

    totals = (
        blocked.filter(F.col(BLOCK) >= 0)
        .groupBy(*keys, BLOCK)
        .agg(*[total(v).alias(v.name) for v in values])
        # A constant per row, so the few block totals of the key-less case are one window group.
        .withColumn(GROUP, F.when(F.col(BLOCK) >= 0, 0))
    )
    before = (
        Window.partitionBy(*(keys or [GROUP]))
        .orderBy(BLOCK)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = {
        "sum": lambda c: F.sum(c).over(before),
        "max": lambda c: F.max(c).over(before),
        "max_before": lambda c: F.max(c).over(before),
        "last": lambda c: F.last(c, ignorenulls=True).over(before),
        "previous": lambda c: F.last(c).over(before),
    }
    carry = totals.select(*keys, BLOCK, *[carried[v.kind](F.col(v.name)).alias(f"_c_{v.name}") for v in values])
    if blocks <= MAX_BROADCAST_BLOCKS:
        carry = F.broadcast(carry)
    joined = join_keys(scanned, carry, [*keys, BLOCK], "left")

    def combined(v: Running) -> Column:
        here, earlier = F.col(v.name), F.col(f"_c_{v.name}")
        if v.kind == "sum":
            return F.when(here.isNull(), earlier).otherwise(here + F.coalesce(earlier, F.lit(0)))
        if v.kind in ("max", "max_before"):
            return F.greatest(here, earlier)
        return F.coalesce(here, earlier)

    return joined.withColumns({v.name: combined(v) for v in values}).drop(*[f"_c_{v.name}" for v in values])


def running_count(name: str) -> Running:
    return Running(name, "sum", F.lit(1).cast("bigint"))
