"""Paired experiments: log, rank tests, intervals, verdict.

Every test takes ``by``, the columns that name an experiment, and judges all
experiments in one job. Ranks are computed over counted values, so neither a
large experiment nor a value shared by most samples ends in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpuslab.functions.numbers import half_up
from corpuslab.functions.stats import rank_sum_p, signed_rank_p, t_quantile_of

from .evaluate import added_counts, metric_columns, ratio, row_counts
from .ranks import ranked_values
from .skew import join_keys

# Seed, confidence, smallest number of pairs, tie band.
SEED = 42
CONFIDENCE = 0.95
MIN_PAIRS = 10
TIE_BAND = 0.001
EXPERIMENT = ["experiment_id"]


def assigned_group(sample: Column, seed: int = SEED, fast: bool = False) -> Column:
    """A or B by a hash of the sample, the same under any partitioning: by the
    last bit of a SHA-256, which any engine can repeat, or ``fast`` of an XXH64."""
    if fast:
        return F.when(F.pmod(F.xxhash64(sample, F.lit(seed)), F.lit(2)) == 0, "A").otherwise("B")
    digest = F.sha2(F.concat_ws(":", F.lit(str(seed)), sample.cast("string")), 256)
    return F.when(F.substring(digest, 64, 1).isin(*"02468ace"), "A").otherwise("B")


def join_arms(gold: DataFrame, a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """One row per sample from three tables with one array per sample."""
    return gold.join(a.withColumnRenamed("pred", "pred_a"), keys).join(b.withColumnRenamed("pred", "pred_b"), keys)


def experiment_log(arms: DataFrame, latencies: DataFrame, keys: list[str], sample: str = "sample_id") -> DataFrame:
    """Per sample: tokens, accuracy, macro F1 over the classes seen, and latency of both arms.

    ``arms`` has the arrays gold, pred_a, pred_b. A sample without counted
    tokens stays, with zeros, and so does one without latencies, with nulls.
    """
    counted = added_counts(row_counts(arms, keys, {"a": "pred_a", "b": "pred_b"}), keys)
    a, b = metric_columns("a"), metric_columns("b")
    return counted.join(latencies, [k for k in keys if k in latencies.columns], "left").select(
        *keys,
        assigned_group(F.col(sample)).alias("assigned_group"),
        half_up("latency_a_ms", 3).alias("latency_a_ms"),
        half_up("latency_b_ms", 3).alias("latency_b_ms"),
        half_up(a["accuracy"], 4).alias("accuracy_a"),
        half_up(b["accuracy"], 4).alias("accuracy_b"),
        half_up(a["macro_f1"], 4).alias("f1_a"),
        half_up(b["macro_f1"], 4).alias("f1_b"),
        "num_tokens",
        a["correct"].alias("correct_a"),
        b["correct"].alias("correct_b"),
    )


def _cubed(n: str) -> Column:
    """t^3 - t of a group of t tied values."""
    t = F.col(n).cast("double")
    return t * t * t - t


def mann_whitney(log: DataFrame, by: list[str], a: str, b: str, group_rows: int | None = None) -> DataFrame:
    """U of the first column, tie-corrected z with continuity correction, two-sided p."""
    both = log.select(
        *by,
        F.inline(
            F.array(
                F.struct(F.col(a).cast("double").alias("value"), F.lit(1).alias("first")),
                F.struct(F.col(b).cast("double").alias("value"), F.lit(0).alias("first")),
            )
        ),
    )
    ranked = ranked_values(both, by, "value", group_rows, n_a=F.col("first"))
    sums = ranked.groupBy(*by).agg(
        F.sum("n_a").alias("n_a"),
        (F.sum("n") - F.sum("n_a")).alias("n_b"),
        F.sum(F.col("n_a") * F.col("mid_rank")).alias("rank_sum"),
        F.sum(_cubed("n")).alias("ties"),
    )
    n_a, n_b = F.col("n_a").cast("double"), F.col("n_b").cast("double")
    size = n_a + n_b
    u = F.col("rank_sum") - n_a * (n_a + 1) / 2
    spread = F.sqrt(n_a * n_b / 12 * ((size + 1) - F.try_divide(F.col("ties"), size * (size - 1))))
    with_u = sums.withColumns({"u_statistic": u, "z": F.greatest(u, n_a * n_b - u) - n_a * n_b / 2 - 0.5})
    scored = with_u.withColumn("z", F.try_divide(F.col("z"), spread))
    p = rank_sum_p("n_a", "n_b", "u_statistic", F.coalesce("z", F.lit(float("nan"))), F.col("ties") > 0)
    return scored.select(*by, "n_a", "n_b", "u_statistic", "z", "ties", p.alias("p_value"))


def wilcoxon(
    log: DataFrame,
    by: list[str],
    a: str,
    b: str,
    round_to: int | None = None,
    group_rows: int | None = None,
) -> DataFrame:
    """Signed-rank test of a - b without zero differences: the smaller rank sum and two-sided p.

    Only groups with more than ten differences appear; the others count as
    statistic 0 and p 1. Differences are compared as they are unless
    ``round_to`` is given.
    """
    apart = F.col(a) - F.col(b)
    if round_to is not None:
        apart = F.round(apart, round_to)
    differences = log.select(*by, apart.alias("d")).filter(F.col("d") != 0)
    sized = differences.select(*by, F.abs("d").alias("size"), (F.col("d") > 0).cast("int").alias("up"))
    ranked = ranked_values(sized, by, "size", group_rows, positive=F.col("up"))
    sums = ranked.groupBy(*by).agg(
        F.sum("n").alias("pairs"),
        F.sum(F.col("positive") * F.col("mid_rank")).alias("w_plus"),
        F.sum((F.col("n") - F.col("positive")) * F.col("mid_rank")).alias("w_minus"),
        F.sum(_cubed("n")).alias("ties"),
    ).filter(F.col("pairs") > MIN_PAIRS)
    m = F.col("pairs").cast("double")
    spread = F.sqrt((m * (m + 1) * (2 * m + 1) - F.col("ties") / 2) / 24)
    scored = sums.withColumn("w_statistic", F.least("w_plus", "w_minus")).withColumn(
        "z", (F.col("w_statistic") - m * (m + 1) / 4) / spread
    )
    p = signed_rank_p("pairs", "w_statistic", "z", F.col("ties") > 0)
    return scored.select(*by, "pairs", "w_plus", "w_minus", "w_statistic", "z", "ties", p.alias("p_value"))


def mean_interval(log: DataFrame, by: list[str], a: str, b: str, level: float = CONFIDENCE) -> DataFrame:
    """Means, mean difference and its t-interval. A single pair has an interval of no width."""
    apart = F.col(a) - F.col(b)
    sums = log.groupBy(*by).agg(
        F.count(F.lit(1)).alias("num_samples"),
        F.avg(a).alias("mean_a"),
        F.avg(b).alias("mean_b"),
        F.avg(apart).alias("mean_difference"),
        (F.stddev_samp(apart) / F.sqrt(F.count(F.lit(1)))).alias("sem"),
    )
    half = F.when(F.col("num_samples") > 1, t_quantile_of(level)("num_samples") * F.col("sem")).otherwise(0.0)
    with_half = sums.withColumn("_half", half)
    return with_half.withColumns(
        {"ci_low": F.col("mean_difference") - F.col("_half"), "ci_high": F.col("mean_difference") + F.col("_half")}
    ).drop("_half")


def significant(p: Column, level: float = CONFIDENCE) -> Column:
    return p < 1 - level


def winner(difference: Column, lower_is_better: bool, band: float = 0.0, compat: bool = False) -> Column:
    """A or B by the sign of mean(a) - mean(b), tie within ``band``.

    ``compat`` names the slower arm for a lower-is-better metric, as the
    recorded reports do.
    """
    above, below = ("B", "A") if lower_is_better and not compat else ("A", "B")
    return F.when(difference > band, above).when(difference < -band, below).otherwise("tie")


# Bands of F1 retention and the recommendation of each.
BANDS = [
    (90, "DEPLOY Student — retains %.1f%% of teacher F1 with %.1fms faster inference"),
    (80, "Student retains %.1f%% of teacher F1 — acceptable for most use cases"),
    (70, "Student retains %.1f%% of teacher F1 — consider for latency-critical deployments"),
    (None, "Student retains only %.1f%% of teacher F1 — further tuning recommended"),
]


def verdict(f1_a: Column, f1_b: Column, faster_ms: Column) -> tuple[Column, Column]:
    """F1 retention in percent, and the recommendation of its band."""
    retention = ratio(f1_b, f1_a) * 100
    text = None
    for limit, template in BANDS:
        values = [half_up(retention, 1)] + ([half_up(faster_ms, 1)] if template.count("%.1f") == 2 else [])
        sentence = F.format_string(template, *values)
        if limit is None:
            return half_up(retention, 1), text.otherwise(sentence)
        text = F.when(retention >= limit, sentence) if text is None else text.when(retention >= limit, sentence)
    raise AssertionError("the last band is open")


def ab_report(
    log: DataFrame, by: list[str] = EXPERIMENT, compat: bool = False, group_rows: int | None = None
) -> DataFrame:
    """One row per experiment and metric: means, interval, test, winner."""
    places = {"latency": 2, "f1_score": 4}

    def part(metric: str, test: str, statistic: str, a: str, b: str, tested: DataFrame, won: Column) -> DataFrame:
        spread = mean_interval(log, by, a, b)
        # Experiments with too few differences have no row in the test.
        both = join_keys(spread, tested.select(*by, F.col(statistic).alias("statistic"), "p_value"), by, "left")
        p = F.coalesce("p_value", F.lit(1.0))
        r = places[metric]
        return both.select(
            *by,
            F.lit(metric).alias("metric"),
            F.lit(test).alias("test"),
            "num_samples",
            *[half_up(c, r).alias(c) for c in ("mean_a", "mean_b", "mean_difference", "ci_low", "ci_high")],
            F.round(F.coalesce("statistic", F.lit(0.0)), 2).alias("statistic"),
            F.round(p, 6).alias("p_value"),
            significant(p).alias("significant"),
            won.alias("winner"),
        )

    difference = F.col("mean_difference")
    latency = part(
        "latency",
        "Mann-Whitney U",
        "u_statistic",
        "latency_a_ms",
        "latency_b_ms",
        mann_whitney(log, by, "latency_a_ms", "latency_b_ms", group_rows),
        winner(difference, lower_is_better=True, compat=compat),
    )
    quality = part(
        "f1_score",
        "Wilcoxon signed-rank",
        "w_statistic",
        "f1_a",
        "f1_b",
        wilcoxon(log, by, "f1_a", "f1_b", group_rows=group_rows),
        winner(difference, lower_is_better=False, band=TIE_BAND),
    )
    return latency.unionByName(quality)


def ab_verdict(log: DataFrame, by: list[str] = EXPERIMENT) -> DataFrame:
    """One row per experiment: retention and recommendation."""
    means = log.groupBy(*by).agg(
        F.count(F.lit(1)).alias("num_samples"),
        half_up(F.avg("f1_a"), 4).alias("f1_a"),
        half_up(F.avg("f1_b"), 4).alias("f1_b"),
        half_up(F.avg(F.col("latency_a_ms") - F.col("latency_b_ms")), 2).alias("faster"),
    )
    retention, recommendation = verdict(F.col("f1_a"), F.col("f1_b"), F.col("faster"))
    return means.select(
        *by, "num_samples", retention.alias("f1_retention_pct"), recommendation.alias("recommendation")
    )


def run_means(log: DataFrame, by: list[str] = EXPERIMENT) -> DataFrame:
    """Mean latency and F1 percent per arm, one row per arm and metric."""
    means = log.groupBy(*by).agg(*[F.avg(c).alias(c) for c in ("latency_a_ms", "latency_b_ms", "f1_a", "f1_b")])

    def row(arm: str, metric: str, value: Column) -> Column:
        return F.struct(F.lit(arm).alias("arm"), F.lit(metric).alias("metric"), value.alias("value"))

    rows = [
        row("A", "latency_ms", F.col("latency_a_ms")),
        row("B", "latency_ms", F.col("latency_b_ms")),
        row("A", "f1_pct", F.col("f1_a") * 100),
        row("B", "f1_pct", F.col("f1_b") * 100),
    ]
    return means.select(*by, F.inline(F.array(*rows)))
