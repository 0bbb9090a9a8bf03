"""Regression checks over stored metric reports; all runs are judged in one pass."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .scan import Running, running


@dataclass(frozen=True)
class Threshold:
    """A limit on one metric. ``op`` is max or min; the texts are formats that
    get the value (and know the limit)."""

    name: str
    component: str
    metric: str
    op: str
    limit: float
    severity: str
    status_effect: int
    shown_component: str
    shown_metric: str
    shown_value: str
    unit: str
    breach: str
    fine: str
    optional: bool = False

    def broken(self, value: Column) -> Column:
        return value > self.limit if self.op == "max" else value < self.limit


# Limits, severities and report texts.
THRESHOLDS = [
    Threshold(
        "max_f1_degradation_pct", "optimization", "f1_degradation_pct", "max", 2.0, "HIGH", 2,
        "Model Optimization", "F1 Degradation", "%.2f%%", "%",
        "F1 dropped %.2f%% after optimization (threshold: 2.0%%)",
        "F1 degradation within range (%.2f%% < 2.0%%)",
    ),
    Threshold(
        "min_speedup_factor", "optimization", "speedup_factor", "min", 2.0, "MEDIUM", 1,
        "Model Optimization", "Speedup Factor", "%.2fx", "x",
        "Speedup %.2fx below target 2.0x (may be hardware-dependent — INT8 optimized for x86 AVX-512)",
        "Speedup meets target (%.2fx >= 2.0x)",
    ),
    Threshold(
        "min_sparsity_pct", "optimization", "sparsity_pct", "min", 35.0, "MEDIUM", 0,
        "Model Optimization", "Sparsity", "%.1f%%", "%",
        "Sparsity %.1f%% below target 35.0%%",
        "Sparsity target met (%.1f%% >= 35.0%%)",
    ),
    Threshold(
        "min_f1_retention_pct", "distillation", "f1_retention_pct", "min", 85.0, "MEDIUM", 1,
        "Distillation", "F1 Retention", "%.1f%%", "%",
        "Student retains %.1f%% of teacher F1 (target: 85.0%%)",
        "F1 retention meets target (%.1f%% >= 85.0%%)",
    ),
    Threshold(
        "max_latency_ms", "optimization", "latency_ms", "max", 50.0, "MEDIUM", 1,
        "Model Optimization", "Latency", "%.2fms", "ms",
        "Latency %.2fms above limit 50.0ms",
        "Latency within limit (%.2fms <= 50.0ms)",
        optional=True,
    ),
]

STATUS = ["PASS", "WARN", "FAIL"]
ALERTING = ["HIGH", "MEDIUM"]
CHANNEL = "#ml-alerts"
SECTION = "summary"
INNER = ("metric_key", "component_key", "variant_key", "status_effect")


def threshold_table(spark: SparkSession, thresholds: list[Threshold] = THRESHOLDS) -> DataFrame:
    rows = [(t.name, t.component, t.metric, t.op, t.limit, t.severity, t.status_effect, t.optional) for t in thresholds]
    return spark.createDataFrame(
        rows,
        "name string, component string, metric string, op string, limit double, severity string, "
        "status_effect int, optional boolean",
    )


def find_regressions(
    metrics: DataFrame,
    by: list[str],
    thresholds: list[Threshold] = THRESHOLDS,
    check_latency: bool = False,
    section: str = SECTION,
) -> DataFrame:
    """One finding per run and threshold whose component reported.

    Takes (by, component, variant, metric, value); without ``variant`` all rows
    belong to ``section``. The value in ``section`` is judged; where that does
    not state the metric, the worst value of the other variants. A metric
    missing inside a report counts as 0; without the report its findings are
    left out. Each report is folded to one row, then the thresholds are literals.
    """
    checked = [t for t in thresholds if check_latency or not t.optional]
    rows = metrics if "variant" in metrics.columns else metrics.withColumn("variant", F.lit(section))
    stated = F.struct("value", "variant")

    def judged(t: Threshold) -> Column:
        worst = F.max if t.op == "max" else F.min
        of_metric = (F.col("metric") == t.metric) & F.col("value").isNotNull()
        own = worst(F.when(of_metric & (F.col("variant") == section), stated))
        return F.coalesce(own, worst(F.when(of_metric, stated))).alias(f"_{t.name}")

    folded = rows.groupBy(*by, "component").agg(*[judged(t) for t in checked])

    def finding(t: Threshold) -> Column:
        value = F.coalesce(F.col(f"_{t.name}")["value"], F.lit(0.0))
        broken = t.broken(value)
        return F.when(
            F.col("component") == t.component,
            F.struct(
                F.lit(t.shown_component).alias("component"),
                F.lit(t.shown_metric).alias("metric"),
                F.lit(t.metric).alias("metric_key"),
                F.lit(t.component).alias("component_key"),
                F.coalesce(F.col(f"_{t.name}")["variant"], F.lit(section)).alias("variant_key"),
                F.format_string(t.shown_value, value).alias("value"),
                F.lit(f"{t.limit}{t.unit}").alias("threshold"),
                F.when(broken, t.severity).otherwise("OK").alias("severity"),
                F.when(broken, F.format_string(t.breach, value))
                .otherwise(F.format_string(t.fine, value))
                .alias("message"),
                F.when(broken, t.status_effect).otherwise(0).alias("status_effect"),
            ),
        )

    rows = F.filter(F.array(*[finding(t) for t in checked]), lambda f: f.isNotNull())
    return folded.select(*by, F.inline(rows))


def overall_status(findings: DataFrame, by: list[str]) -> DataFrame:
    """FAIL if a finding fails the run, else WARN if one warns, else PASS. Not
    every breach has an effect: one of sparsity changes nothing."""
    worst = F.get(F.array(*[F.lit(s) for s in STATUS]), F.max("status_effect"))
    return findings.groupBy(*by).agg(worst.alias("overall_status"), F.count(F.lit(1)).alias("findings"))


def alerts(findings: DataFrame, channel: str = CHANNEL) -> DataFrame:
    return findings.filter(F.col("severity").isin(ALERTING)).select(
        F.lit(channel).alias("channel"), *[c for c in findings.columns if c not in INNER]
    )


def alert_summary(findings: DataFrame, by: list[str]) -> DataFrame:
    """Alerts per run and whether anything must be done."""
    count = F.count_if(F.col("severity").isin(ALERTING))
    return findings.groupBy(*by).agg(
        count.alias("alerts_triggered"), (count > 0).alias("action_required")
    )


def combine_reports(reports: dict[str, DataFrame]) -> DataFrame:
    """Reports of several components in one long table."""
    named = [df.withColumn("component", F.lit(component)) for component, df in reports.items()]
    return reduce(lambda a, b: a.unionByName(b), named)


def display_value(metric: Column, value: Column) -> Column:
    """A metric as shown in the summary; the unit follows from its name."""

    def shown(template: str, number: Column, places: int) -> Column:
        return F.format_string(template, F.round(number, places))

    return (
        F.when(metric.endswith("_f1"), shown("%.2f%%", value * 100, 2))
        .when(metric.endswith("_ms"), shown("%.2f ms", value, 2))
        .when(metric.endswith("_mb"), shown("%.1f MB", value, 1))
        .when(metric.startswith("speedup"), shown("%.2fx", value, 2))
        .when(metric.endswith("_pct"), shown("%.2f%%", value, 2))
        .when(metric == "parameters", shown("%,.0f", value, 0))
        .otherwise(shown("%.4f", value, 4))
    )


def evaluation_summary(
    report: DataFrame, findings: DataFrame, run: str, group_rows: int | None = None
) -> DataFrame:
    """Every metric of every run as shown, with its change since the run before
    and the finding on it, if it is the value that was judged. ``run`` orders the runs (number, date or timestamp)."""
    keys = ["component", "variant", "metric"]
    earlier = running(report, keys, [run], [Running("previous", "previous", F.col("value"))], group_rows)
    notes = findings.select(
        run,
        F.col("component_key").alias("component"),
        F.col("variant_key").alias("variant"),
        F.col("metric_key").alias("metric"),
        "severity",
        "message",
    )
    return earlier.join(notes, [run, *keys], "left").select(
        run,
        *keys,
        display_value(F.col("metric"), F.col("value")).alias("shown"),
        (F.col("value") - F.col("previous")).alias("change"),
        "severity",
        "message",
    )
