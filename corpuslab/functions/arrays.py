"""Column expressions over arrays."""

from __future__ import annotations

from collections.abc import Callable
from math import isqrt

from pyspark.sql import Column, DataFrame, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value computed once.

    A column used inside the lambda of an array function is evaluated again for
    every element; bound like this it is not, and it stays a plain JVM array
    between the steps.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def tail(values: Column) -> Column:
    """All elements but the first."""
    return F.slice(values, F.lit(2), F.size(values))


def chunked(cuts: list[float]) -> list[list[float]]:
    """Ascending cut points in pieces of about the square root of their number."""
    width = max(1, isqrt(len(cuts)))
    return [cuts[i : i + width] for i in range(0, len(cuts), width)]


def chunk_literal(cuts: list[float]) -> Column:
    """Chunked cut points as a constant column."""
    parts = [F.array(*[F.lit(float(c)) for c in chunk]) for chunk in chunked(cuts)]
    return F.array(*parts).cast("array<array<double>>")


def cuts_passed(chunks: Column, value: Column, include: bool) -> Column:
    """How many of the chunked cut points lie below ``value`` (or at it, with
    ``include``): first over the chunks, then inside one."""

    def below(cut: Column) -> Column:
        return cut <= value if include else cut < value

    def inside(chunk: Column) -> Column:
        done = (chunk - 1) * F.size(F.get(chunks, F.lit(0)))
        rest = F.size(F.filter(F.get(chunks, chunk - 1), below))
        return F.when(chunk == 0, 0).otherwise(done + rest)

    return let(F.size(F.filter(chunks, lambda c: below(F.get(c, F.lit(0))))), inside)


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later filters read instead of computing them again.

    The optimizer moves a filter below a projection by copying its expressions
    and infers filters for exploded arrays; it does not look through a
    generator, so the columns come out of one that yields a single row.
    """
    values = [value.alias(name) for name, value in columns.items()]
    return df.select(*[c for c in df.columns if c not in columns], F.inline_outer(F.array(F.struct(*values))))


def rows_of(df: DataFrame, keep: list[str], array: Column | str, *names: str) -> DataFrame:
    """One row per element of an array (of structs: their fields). ``names``
    names the element of a plain array. Null elements are left out."""
    if names:
        rows = df.select(*keep, F.explode_outer(array).alias(*names))
        return rows.filter(F.col(names[0]).isNotNull())
    # The outer form, because the plain one makes the optimizer compute the array a second time for a filter.
    return df.select(*keep, F.explode_outer(array).alias("_e")).filter(F.col("_e").isNotNull()).select(*keep, "_e.*")
