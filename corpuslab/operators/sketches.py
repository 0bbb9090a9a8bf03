"""Quantiles from stored states that can be merged: a sketch per group and
minute answers for any later window without the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .requests import By

#: Items a sketch keeps per level; the error falls nearly in proportion.
SKETCH_SIZE = 400


def rank_error(size: int = SKETCH_SIZE) -> float:
    """How far the rank of a returned quantile may be from the wanted one, as a
    share of the rows, with 99 % confidence. Merging does not add to it."""
    return 2.296 / size**0.9723


def sketched(df: DataFrame, by: By, value: str | Column, size: int = SKETCH_SIZE) -> DataFrame:
    """Per group one ``sketch`` of the values; rows without one are left out.
    Groups in which there is none have no row. Also for streams."""
    observed = (F.col(value) if isinstance(value, str) else value).cast("double")
    return df.filter(observed.isNotNull()).groupBy(*by).agg(F.kll_sketch_agg_double(observed, F.lit(size)).alias("sketch"))


def latency_sketches(log: DataFrame, keys: list[str], span: str = "1 minute", size: int = SKETCH_SIZE) -> DataFrame:
    """A sketch of the latencies per time span and ``keys``, to be stored."""
    return sketched(log, [F.window("timestamp", span), *keys], "latency_ms", size)


def merged(sketches: DataFrame, by: By) -> DataFrame:
    """One sketch for each wider group. Partial sketches are merged before the
    shuffle, so a hot group sends one per task."""
    return sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch").alias("sketch"))


def later_window(span: str) -> Column:
    """The wider window that a stored row's window begins in."""
    return F.window(F.col("window.start"), span).alias("window")


def sketch_quantiles(sketches: DataFrame, quantiles: tuple[float, ...] = (0.5, 0.95, 0.99)) -> DataFrame:
    """Every column but the sketch, with ``count`` and a column per quantile."""
    kept = [c for c in sketches.columns if c != "sketch"]
    found = [F.kll_sketch_get_quantile_double("sketch", F.lit(float(q))).alias(f"p{q * 100:g}") for q in quantiles]
    return sketches.select(*kept, F.kll_sketch_get_n_double("sketch").alias("count"), *found)
