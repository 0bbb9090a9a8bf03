"""Joins that stay balanced when a few keys hold most rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

MAX_BROADCAST_ROWS = 10_000


def join_keys(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join where null keys match, keeping the left key columns. Without
    keys ``right`` is the one row of an aggregate over everything."""
    if not keys:
        return left.join(F.broadcast(right), F.lit(True), how)
    renamed = reduce(lambda d, k: d.withColumnRenamed(k, f"_r_{k}"), keys, right)
    same = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(renamed, reduce(Column.__and__, same), how).drop(*[f"_r_{k}" for k in keys])


def as_local(df: DataFrame, rows: list) -> DataFrame:
    """A driver-held frame over already collected, bounded ``rows``."""
    return df.sparkSession.createDataFrame(rows, df.schema)


def small_side(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``max_rows`` rows.

    The check fetches no more than ``max_rows + 1`` rows. A larger frame is
    returned as it is, and the join is left to adaptive execution.
    """
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return df
    return F.broadcast(as_local(df, rows))


def lookup_join(
    big: DataFrame,
    lookup: DataFrame,
    key: str,
    weight: str,
    hot_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Inner join of ``big`` with a table that has one row per ``key``.

    ``weight`` is the number of rows of ``big`` behind each key. The keys
    heavier than the one at rank ``hot_rows`` are broadcast, at most that many,
    so their rows never move; what is left holds no key with more than
    1 / hot_rows of the rows and is joined by an ordinary shuffle. Every row is
    kept. ``lookup`` is read several times, so pass a written table.
    """
    heaviest = lookup.orderBy(F.desc(weight)).limit(hot_rows + 1)
    row = heaviest.agg(F.count(F.lit(1)).alias("n"), F.min(weight).alias("cut")).collect()[0]
    if row["n"] <= hot_rows:
        return big.join(F.broadcast(lookup), key)
    hot = lookup.filter(F.col(weight) > row["cut"])
    by_broadcast = big.join(F.broadcast(hot), key)
    cold = big.join(F.broadcast(hot.select(key)), key, "left_anti").join(lookup, key)
    return by_broadcast.unionByName(cold.select(*by_broadcast.columns))
