"""Column expressions over numbers."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F


def half_up(value: Column | str, places: int) -> Column:
    """Rounded half up. Noise beyond 10 places, which depends on the order of a
    sum, is removed first, so that it cannot tip a half."""
    return F.round(F.round(value, 10), places)


def exact_decimals(df: DataFrame, columns: list[str]) -> dict[str, Column]:
    """Columns as decimals of 38 digits whose sums are exact in any order.

    Their scale comes from the largest value: 13 digits are left for the sum of
    many rows, the other 25 are for one value, more than a double has. What is
    not a number is null.
    """
    finite = {c: F.when(F.abs(F.col(c).cast("double")) < float("inf"), F.col(c)) for c in columns}
    largest = df.agg(*[F.max(F.abs(finite[c].cast("double"))).alias(c) for c in columns]).first()

    def scale(value: float | None) -> int:
        digits = math.floor(math.log10(value)) + 1 if value else 0
        return min(37, max(0, 25 - digits))

    return {c: finite[c].cast(f"decimal(38,{scale(largest[c])})") for c in columns}
