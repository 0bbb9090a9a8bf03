"""Exact ranks, percentiles and order statistics for data of any size."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from corpuslab.functions.arrays import chunk_literal, cuts_passed
from corpuslab.session import via_table

from .scan import Running, running
from .skew import join_keys, lookup_join, small_side

SELECT_BUCKETS = 256
SELECT_GATHER = 50_000
TOP_N = 10_000
WORD_BYTES = 6
TIE = "_tie"


def value_counts(df: DataFrame, by: list[str], value: str, **counts: Column) -> DataFrame:
    """One row per distinct value and group; combined before the shuffle, so a
    value that fills the table still reaches the shuffle once per task."""
    sums = {"n": F.lit(1), **counts}
    return df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(
        *[F.sum(c.cast("bigint")).alias(name) for name, c in sums.items()]
    )


def ranked_values(
    df: DataFrame, by: list[str], value: str, group_rows: int | None = None, **counts: Column
) -> DataFrame:
    """Distinct values with count ``n``, rows up to and including them
    ``upto`` and the rank ``mid_rank`` that their tied rows share."""
    counted = value_counts(df, by, value, **counts)
    scanned = running(
        counted,
        by,
        [value],
        [Running("upto", "sum", F.col("n"))],
        group_rows,
        sizing=df.filter(F.col(value).isNotNull()).select(*by, value),
    )
    return scanned.withColumn("mid_rank", F.col("upto") - F.col("n") + (F.col("n") + 1) / 2)


def mid_rank(df: DataFrame, value: str, group_rows: int | None = None) -> DataFrame:
    """Every row with the average rank of its value; null values have none and are left out."""
    # Written once: the join looks at the heaviest values first and then at all of them.
    ranks = via_table(ranked_values(df, [], value, group_rows).select(value, "n", "mid_rank"), "ranks")
    return lookup_join(df, ranks, value, "n").drop("n")


def percentiles(
    df: DataFrame,
    by: list[str],
    value: str,
    fractions: dict[str, float],
    group_rows: int | None = None,
) -> DataFrame:
    """Exact percentiles per group with linear interpolation between ranks."""
    # Rounded so that 0.95 of 100 steps is 95 and not just below it.
    spots = {name: (lambda n, p=p: F.round(p * (n - 1), 9)) for name, p in fractions.items()}
    return order_statistics(df, by, value, spots, group_rows)


def nearest_ranks(
    df: DataFrame,
    by: list[str],
    value: str,
    fractions: dict[str, float],
    group_rows: int | None = None,
) -> DataFrame:
    """The value at 0-based rank floor(fraction * n) of each group, not interpolated."""
    spots = {name: (lambda n, p=p: F.least(F.floor(n * p), n - 1)) for name, p in fractions.items()}
    return order_statistics(df, by, value, spots, group_rows)


def order_statistics(
    df: DataFrame,
    by: list[str],
    value: str,
    spots: dict[str, Callable[[Column], Column]],
    group_rows: int | None = None,
) -> DataFrame:
    """Values at 0-based ranks given as functions of the group size; a rank
    between two rows is interpolated."""
    ranked = ranked_values(df, by, value, group_rows)
    size = "_size"
    sizes = df.filter(F.col(value).isNotNull()).groupBy(*by).agg(F.count(F.lit(1)).alias(size))
    if by:
        with_size = join_keys(ranked, small_side(sizes), by)
    else:
        with_size = ranked.withColumn(size, sizes.scalar())
    first = F.col("upto") - F.col("n")

    def holds(rank: Column) -> Column:
        return (first <= rank) & (rank < F.col("upto"))

    at = {name: spot(F.col(size)) for name, spot in spots.items()}
    hits = with_size.filter(_any([holds(F.floor(s)) | holds(F.ceil(s)) for s in at.values()]))
    ends = []
    for name, spot in at.items():
        ends += [
            F.max(F.when(holds(F.floor(spot)), F.col(value))).alias(f"_lo_{name}"),
            F.max(F.when(holds(F.ceil(spot)), F.col(value))).alias(f"_hi_{name}"),
            F.max(spot - F.floor(spot)).alias(f"_at_{name}"),
        ]
    found = hits.groupBy(*by).agg(*ends)
    between = [
        (F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * F.col(f"_at_{n}")).alias(n) for n in spots
    ]
    return found.select(*by, *between)


def _any(conditions: list[Column]) -> Column:
    result = conditions[0]
    for c in conditions[1:]:
        result = result | c
    return result


def select_rank(
    df: DataFrame,
    value: str,
    rank: int,
    weight: str | None = None,
    buckets: int = SELECT_BUCKETS,
    gather: int = SELECT_GATHER,
) -> tuple[object, int] | None:
    """The value at 1-based ``rank`` in ascending order, and how many rows lie
    strictly below it; None when there are fewer rows.

    Each round splits the remaining range at approximate quantiles and counts
    the parts exactly, so only counts travel. ``weight`` counts a row several
    times.
    """
    times = F.lit(1) if weight is None else F.col(weight)
    rows = df.filter(F.col(value).isNotNull() & (times > 0)).select(
        F.col(value).alias("v"), times.cast("bigint").alias("w")
    )
    below = 0
    fractions = [i / buckets for i in range(1, buckets)]
    while True:
        cuts = rows.agg(F.percentile_approx("v", fractions, 10_000).alias("c")).collect()[0]["c"]
        if not cuts:
            return None
        part = cuts_passed(chunk_literal(sorted(set(cuts))), F.col("v").cast("double"), include=False)
        parts = (
            rows.groupBy(part.alias("part"))
            .agg(F.sum("w").alias("w"), F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
            .orderBy("part")
            .collect()
        )
        for row in parts:
            if below + row["w"] >= rank:
                break
            below += row["w"]
        else:
            return None
        if row["lo"] == row["hi"]:
            return row["lo"], below
        rows = rows.filter(F.col("v").between(F.lit(row["lo"]), F.lit(row["hi"])))
        if row["n"] <= gather:
            for found in rows.groupBy("v").agg(F.sum("w").alias("w")).orderBy("v").collect():
                if below + found["w"] >= rank:
                    return found["v"], below
                below += found["w"]


def select_text(df: DataFrame, column: str, rank: int, gather: int = SELECT_GATHER) -> tuple[str, int] | None:
    """The string at 1-based ``rank`` in ascending byte order, and how many rows
    lie strictly below it; None when there are fewer rows.

    Strings are read as numbers of six bytes, from the front: the number at the
    rank is selected, and only rows that have it go on.
    """
    rows = df.filter(F.col(column).isNotNull()).select(F.col(column).alias("v"))
    below, at = 0, 1
    while True:
        size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.octet_length("v")).alias("longest")).first()
        if below + size["n"] < rank:
            return None
        if size["n"] <= gather or size["longest"] < at:
            for found in rows.groupBy("v").agg(F.count(F.lit(1)).alias("n")).orderBy("v").collect():
                if below + found["n"] >= rank:
                    return found["v"], below
                below += found["n"]
        digits = F.rpad(F.hex(F.substring(F.col("v").cast("binary"), at, WORD_BYTES)), 2 * WORD_BYTES, "0")
        coded = rows.withColumn("_code", F.conv(digits, 16, 10).cast("bigint"))
        code, less = select_rank(coded, "_code", rank - below)
        rows = coded.filter(F.col("_code") == code).drop("_code")
        below, at = below + less, at + WORD_BYTES


def first_n(df: DataFrame, order: str | list[str], n: int, gather: int | None = None) -> DataFrame:
    """The first ``n`` rows by the ``order`` columns, ascending, nulls first.

    Rows that tie in all of them follow a hash of their columns (maps aside), so
    the result does not depend on the partitioning, and has ``n`` rows if the
    table has. Up to ``gather`` rows (10,000) are an ordered limit; for more the cut-off
    is selected first, since an ordered limit would end in a single task, and
    only its ties are cut by the columns after it.
    """
    names = [order] if isinstance(order, str) else list(order)
    plain = [c for c, kind in df.dtypes if "map<" not in kind]
    tied = df.withColumn(TIE, F.xxhash64(*plain))
    return _first(tied, [*names, TIE], n, TOP_N if gather is None else gather).drop(TIE)


def _first(df: DataFrame, names: list[str], n: int, gather: int) -> DataFrame:
    if n <= gather or not names:
        return df.orderBy(*names).limit(n) if names else df.limit(n)
    name, rest = names[0], names[1:]
    missing = df.filter(F.col(name).isNull())
    nulls = missing.count()
    if n <= nulls:
        return _first(missing, rest, n, gather)
    is_text = isinstance(df.schema[name].dataType, T.StringType)
    found = (select_text if is_text else select_rank)(df, name, n - nulls)
    if found is None:
        return df
    cut, below = found
    before = df.filter(F.col(name).isNull() | (F.col(name) < F.lit(cut)))
    ties = df.filter(F.col(name) == F.lit(cut))
    wanted = n - nulls - below
    return before.unionByName(_first(ties, rest, wanted, gather))
