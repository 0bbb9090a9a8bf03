"""Request-log analytics; every function but the running ones takes a batch or a streaming frame.

``by`` lists column names or Columns. A time window is one of them:
``F.window("timestamp", "5 minutes")``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from corpuslab.functions.numbers import exact_decimals

from .panes import pane_of, sliding
from .ranks import nearest_ranks
from .scan import Running, running, running_count
from .skew import join_keys, small_side
from .spans import on_grid

By = list[str | Column]

# Histogram bounds, service level in milliseconds, compliance bands.
LATENCY_BOUNDS = [0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5]
INPUT_LENGTH_BOUNDS = [16, 32, 64, 128, 256, 512]
CONFIDENCE_BOUNDS = [0.5, 0.6, 0.7, 0.8, 0.9, 0.95, 0.99]
BATCH_SIZE_BOUNDS = [1, 2, 4, 8, 16, 32]
SLA_MS = 50.0
SLA_BANDS = [(99, "green"), (95, "yellow"), (0, "red")]


def request_status(log: DataFrame) -> Column:
    """success or error; a line that could not be read is malformed, neither."""
    failed = (F.col("level") == "ERROR") | F.col("error_type").isNotNull()
    known = F.when(failed, "error").otherwise("success")
    return F.when(F.col("corrupt").isNotNull(), "malformed").otherwise(known) if "corrupt" in log.columns else known


def request_counts(log: DataFrame, by: By | None = None) -> DataFrame:
    return log.groupBy(*(by or []), "model_version", request_status(log).alias("status")).agg(
        F.count(F.lit(1)).alias("requests")
    )


def error_counts(log: DataFrame, by: By | None = None) -> DataFrame:
    return (
        log.filter(F.col("error_type").isNotNull())
        .groupBy(*(by or []), "model_version", "error_type")
        .agg(F.count(F.lit(1)).alias("errors"))
    )


def entity_counts(log: DataFrame, by: By | None = None) -> DataFrame:
    return (
        log.select("timestamp", "model_version", F.explode("entity_counts").alias("entity_type", "_n"))
        .groupBy(*(by or []), "model_version", "entity_type")
        .agg(F.sum("_n").alias("entities"))
    )


# ---- histograms


def buckets(df: DataFrame, by: By, value: str | Column, bounds: list[float]) -> DataFrame:
    """Per group the array ``cumulative`` (rows up to each bound, then all rows), sum and count.

    One aggregate with a counter per bound; nothing is multiplied by the number
    of bounds, and a stream keeps only these counters.
    """
    observed = F.col(value) if isinstance(value, str) else value
    counters = [F.count_if(observed <= b).alias(f"_le{i}") for i, b in enumerate(bounds)]
    names = [F.col(f"_le{i}") for i in range(len(bounds))]
    counted = df.groupBy(*by).agg(*counters, F.count(observed).alias("count"), F.sum(observed).alias("sum"))
    kept = [c for c in counted.columns if not c.startswith("_le")]
    return counted.select(*kept, F.array(*names, F.col("count")).alias("cumulative"))


def bucket_rows(counted: DataFrame, bounds: list[float]) -> DataFrame:
    """One row per group and bound ``le`` ("+Inf" for the last)."""
    labels = F.array(*[F.lit(f"{b:g}") for b in bounds], F.lit("+Inf"))
    kept = [c for c in counted.columns if c != "cumulative"]
    rows = F.zip_with(labels, "cumulative", lambda le, n: F.struct(le.alias("le"), n.alias("bucket")))
    return counted.select(*kept, F.inline(rows))


def bucket_quantile(cumulative: Column, bounds: list[float], q: float) -> Column:
    """Quantile from bucket counts: linear inside a bucket that starts at the
    bound below (0 for the first); the highest bound if it lies beyond."""
    total = F.element_at(cumulative, -1)
    rank = total * q
    at = F.array_position(F.transform(cumulative, lambda n: n >= rank), True).cast("int")
    edges = F.array(F.lit(0.0), *[F.lit(float(b)) for b in bounds])
    low, high = F.get(edges, at - 1), F.get(edges, at)
    below = F.coalesce(F.get(cumulative, at - 2), F.lit(0))
    inside = F.get(cumulative, at - 1) - below
    return (
        F.when(total == 0, F.lit(None).cast("double"))
        .when(at > len(bounds), F.lit(float(bounds[-1])))
        .otherwise(low + (high - low) * F.try_divide(rank - below, inside))
    )


def latency_seconds() -> Column:
    return F.col("latency_ms") / 1000


def latency_quantiles(log: DataFrame, by: By, quantiles: tuple[float, ...] = (0.5, 0.95, 0.99)) -> DataFrame:
    """Quantiles in seconds from the latency buckets of each group."""
    counted = buckets(log.filter(F.col("latency_ms").isNotNull()), by, latency_seconds(), LATENCY_BOUNDS)
    kept = [c for c in counted.columns if c not in ("cumulative", "sum")]
    found = [bucket_quantile(F.col("cumulative"), LATENCY_BOUNDS, q).alias(f"p{q * 100:g}") for q in quantiles]
    return counted.select(*kept, *found)


def batch_sizes(log: DataFrame, span: str = "1 minute") -> DataFrame:
    """Requests per version and time span, the rows of the batch-size histogram."""
    return log.groupBy("model_version", F.window("timestamp", span)).agg(F.count(F.lit(1)).alias("batch_size"))


# ---- service level


def sla_split(log: DataFrame, by: By | None = None, limit_ms: float = SLA_MS) -> DataFrame:
    late = F.col("latency_ms") > limit_ms
    return (
        log.filter(F.col("latency_ms").isNotNull())
        .groupBy(*(by or []), "model_version")
        .agg(F.count_if(late).alias("violations"), F.count_if(~late).alias("within"))
    )


def sla_compliance(split: DataFrame) -> DataFrame:
    """Share within the service level in percent, and its colour band."""
    share = F.try_divide(F.col("within") * 100, F.col("within") + F.col("violations"))
    (top, best), *rest = SLA_BANDS
    colour = F.when(share >= top, best)
    for floor, name in rest:
        colour = colour.when(share >= floor, name)
    return split.withColumns({"compliance_pct": share, "band": colour})


# ---- rates over time windows


def per_second(counted: DataFrame, count: str, seconds: int, rate: str = "rate") -> DataFrame:
    """Add count / seconds and the window start as a column; events are exact,
    so nothing is extrapolated to the window edges."""
    kept = [c for c in counted.columns if c != "window"]
    return counted.select(
        F.col("window.start").alias("window_start"), *kept, (F.col(count) / seconds).alias(rate)
    )


def over_windows(
    counted: Callable[[Column], DataFrame], keys: list[str], counts: list[str], span: str, slide: str | None
) -> DataFrame:
    """Counts of ``counted`` (given the time window to group by) over windows of
    ``span``; with ``slide`` events are counted by panes, which add up."""
    if slide is None:
        return counted(F.window("timestamp", span))
    return sliding(counted(pane_of("timestamp", span, slide)), keys, counts, span, slide)


def request_rate(log: DataFrame, span: str = "1 minute", seconds: int = 60, slide: str | None = None) -> DataFrame:
    counted = over_windows(lambda w: request_counts(log, [w]), ["model_version", "status"], ["requests"], span, slide)
    return per_second(counted, "requests", seconds)


def entity_rate(log: DataFrame, span: str = "5 minutes", seconds: int = 300, slide: str | None = None) -> DataFrame:
    counted = over_windows(lambda w: entity_counts(log, [w]), ["model_version", "entity_type"], ["entities"], span, slide)
    return per_second(counted, "entities", seconds)


def error_rate(log: DataFrame, span: str = "5 minutes", seconds: int = 300, slide: str | None = None) -> DataFrame:
    counted = over_windows(lambda w: error_counts(log, [w]), ["model_version", "error_type"], ["errors"], span, slide)
    return per_second(counted, "errors", seconds)


def windowed_buckets(
    df: DataFrame, keys: list[str], value: str | Column, bounds: list[float], span: str, slide: str | None
) -> DataFrame:
    """``buckets`` without the sum, over time windows; panes add up per counter."""
    if slide is None:
        return buckets(df, [F.window("timestamp", span), *keys], value, bounds).drop("sum")
    names = [f"_le{i}" for i in range(len(bounds))]

    def counted(window: Column) -> DataFrame:
        found = buckets(df, [window, *keys], value, bounds)
        return found.select("window", *keys, *[F.get("cumulative", i).alias(n) for i, n in enumerate(names)], "count")

    added = over_windows(counted, keys, [*names, "count"], span, slide)
    return added.select("window", *keys, "count", F.array(*names, "count").alias("cumulative"))


def windowed_quantiles(log: DataFrame, span: str = "5 minutes", slide: str | None = None) -> DataFrame:
    answered = log.filter(F.col("latency_ms").isNotNull())
    counted = windowed_buckets(answered, ["model_version"], latency_seconds(), LATENCY_BOUNDS, span, slide)
    found = [bucket_quantile(F.col("cumulative"), LATENCY_BOUNDS, q).alias(f"p{q * 100:g}") for q in (0.5, 0.95, 0.99)]
    return counted.select(F.col("window.start").alias("window_start"), "model_version", "count", *found)


def bucket_rate(
    df: DataFrame,
    value: str,
    bounds: list[float],
    span: str = "5 minutes",
    seconds: int = 300,
    slide: str | None = None,
) -> DataFrame:
    """Rate per second of every bucket of ``value``."""
    known = df.filter(F.col(value).isNotNull())
    counted = windowed_buckets(known, ["model_version"], value, bounds, span, slide)
    return per_second(bucket_rows(counted.drop("count"), bounds), "bucket", seconds)


# ---- load tests, sessions, gauges


def load_test_summary(results: DataFrame, by: list[str], group_rows: int | None = None) -> DataFrame:
    """Successes, errors, mean, p95 and violations of each load test. p95 is
    the value at rank floor(0.95 n) of the sorted latencies."""
    good = F.col("status") == "success"
    latency = F.when(good, F.col("latency_ms"))
    counted = results.groupBy(*by).agg(
        F.count_if(good).alias("successes"),
        F.count_if(F.col("status") == "error").alias("errors"),
        F.avg(latency).alias("mean_ms"),
        F.count_if(latency > SLA_MS).alias("violations"),
    )
    p95 = nearest_ranks(results.filter(good), by, "latency_ms", {"p95_ms": 0.95}, group_rows)
    return join_keys(counted, p95, by, "left")


def by_gap(log: DataFrame, session: str, order: list[str], gap_seconds: int, group_rows: int | None = None) -> DataFrame:
    """``log`` with ``_part``: the number of gaps of more than ``gap_seconds``
    before a row in its session. ``order`` begins with a timestamp."""
    at = F.unix_micros(order[0])
    before = running(log, [session], order, [Running("_before", "previous", at)], group_rows)
    new = (at - F.col("_before") > gap_seconds * 1_000_000).cast("bigint")
    return running(before, [session], order, [Running("_part", "sum", F.coalesce(new, F.lit(0)))], group_rows).drop("_before")


def session_metrics(
    log: DataFrame,
    session: str,
    order: list[str],
    limit_ms: float = SLA_MS,
    group_rows: int | None = None,
    gap_seconds: int | None = None,
) -> DataFrame:
    """Per answered request: requests, entities, mean latency and share below
    the limit so far in its session. Long sessions are scanned in blocks. With
    ``gap_seconds`` a session ends after as long without a request, and the
    numbers begin again."""
    answered = log.filter(F.col("latency_ms").isNotNull())
    keys = [session]
    if gap_seconds is not None:
        answered, keys = by_gap(answered, session, order, gap_seconds, group_rows), [session, "_part"]
    entities = F.aggregate(
        F.map_values(F.coalesce("entity_counts", F.create_map().cast("map<string,int>"))),
        F.lit(0).cast("bigint"),
        lambda a, n: a + n,
    )
    exact = exact_decimals(answered, ["latency_ms"])["latency_ms"]
    scanned = running(
        answered.withColumn("_entities", entities),
        keys,
        order,
        [
            running_count("requests"),
            Running("entities", "sum", F.col("_entities")),
            Running("_total", "sum", exact),
            Running("_within", "sum", F.when(F.col("latency_ms") < limit_ms, 1).otherwise(0).cast("bigint")),
        ],
        group_rows,
    )
    return scanned.select(
        session,
        *order,
        "requests",
        "entities",
        (F.col("_total").cast("double") / F.col("requests")).alias("mean_latency_ms"),
        (F.col("_within") * 100 / F.col("requests")).alias("sla_pct"),
    )


def edges_of() -> Column:
    """Begin and end of a request, with what they add to started and ended."""
    end = F.unix_micros("timestamp")
    begin = end - F.round(F.coalesce("latency_ms", F.lit(0.0)) * 1000).cast("bigint")

    def edge(at: Column, started: int, ended: int) -> Column:
        return F.struct(F.timestamp_micros(at).alias("edge"), F.lit(started).alias("started"), F.lit(ended).alias("ended"))

    return F.array(edge(begin, 1, 0), edge(end, 0, 1))


def active_requests(
    log: DataFrame, span_seconds: int = 60, group_rows: int | None = None, dense: bool = True
) -> DataFrame:
    """Requests in flight at the end of every time span between the first and
    the last in which one began or ended; without ``dense`` of those spans only.

    A log line is written when a request ends, so it began latency_ms earlier.
    """
    span_start = F.floor(F.unix_micros("edge") / (span_seconds * 1_000_000)) * span_seconds
    edges = log.select(F.inline(edges_of())).withColumn("span_start", span_start)
    counted = edges.groupBy("span_start").agg(F.sum("started").alias("started"), F.sum("ended").alias("ended"))
    gauge = running(
        counted,
        [],
        ["span_start"],
        [Running("in_flight", "sum", F.col("started") - F.col("ended"))],
        group_rows,
        sizing=edges,
    )
    return on_grid(gauge, "span_start", "in_flight", ["started", "ended"], span_seconds, group_rows) if dense else gauge


def freshness(log: DataFrame, as_of: Column | None = None, max_age_seconds: int | None = None) -> DataFrame:
    """Last event and readiness of each version: seen at all or, with
    ``max_age_seconds``, seen that recently before ``as_of``."""
    last = log.groupBy("model_version").agg(F.max("timestamp").alias("last_seen"), F.count(F.lit(1)).alias("events"))
    healthy = F.col("last_seen").isNotNull()
    if max_age_seconds is not None:
        age = F.unix_seconds(F.current_timestamp() if as_of is None else as_of) - F.unix_seconds("last_seen")
        healthy = healthy & (age <= max_age_seconds)
    return last.withColumn("status", F.when(healthy, "healthy").otherwise("not_ready"))


def first_per_request(log: DataFrame) -> DataFrame:
    """The earliest row of every request id; an id repeated very often is
    reduced before the shuffle. Rows without an id are all kept. Batch only."""
    ordered = ["timestamp", *[c for c, kind in log.dtypes if not kind.startswith("map") and c != "timestamp"]]
    kept = log.filter(F.col("request_id").isNotNull()).groupBy("request_id").agg(F.min_by(F.struct("*"), F.struct(*ordered)).alias("_row"))
    return kept.select("_row.*").unionByName(log.filter(F.col("request_id").isNull()))


def sla_report(log: DataFrame) -> DataFrame:
    """Counters of each version side by side: requests, errors, compliance."""
    errors = F.count_if(request_status(log) == "error").alias("errors")
    counts = log.groupBy("model_version").agg(F.count(F.lit(1)).alias("requests"), errors)
    return join_keys(counts, small_side(sla_compliance(sla_split(log))), ["model_version"], "left")
