"""Queries over metric reports; each day of events makes one run with two reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpuslab.operators import regress as rg
from corpuslab.session import scratch_path, via_table
from corpuslab.sources import files

from . import tables as t
from .registry import registry

QUERIES, ORACLES, query = registry()

def daily(spark: SparkSession, sf: str) -> DataFrame:
    """Mean value per event type, share of small values and largest value of each day."""

    def mean(kind: str) -> Column:
        of_kind = F.col("event_type") == kind
        total = F.sum(F.when(of_kind, F.col("value").cast("decimal(18,2)"))).cast("double")
        return total / F.count_if(of_kind)

    small = F.count_if(F.col("value") < 12) / F.count(F.lit(1))
    days = t.table(spark, sf, "events").groupBy(F.dayofyear("ts").alias("run_id"))
    return days.agg(
        *[mean(k).alias(k) for k in ("click", "view", "signup", "purchase", "error")],
        small.alias("small"),
        F.max("value").alias("highest"),
    )


DAILY = f"""daily AS (
  SELECT CAST(dayofyear(ts) AS INTEGER) AS run_id,
    {', '.join(f"CAST(sum(CAST(value AS DECIMAL(18, 2))) FILTER (event_type = '{k}') AS DOUBLE) / count(*) FILTER (event_type = '{k}') AS {k}" for k in ('click', 'view', 'signup', 'purchase', 'error'))},
    count(*) FILTER (value < 12) / count(*) AS small, max(value) AS highest
  FROM events GROUP BY 1)"""


def reports(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """(run_id, report) JSON of both components. Every fifth day has no
    distillation report, every seventh no speed-up in the other one's summary;
    two variants and both components state a speed-up of their own."""
    days = daily(spark, sf)
    speedup = F.when(F.col("run_id") % 7 != 0, F.round(F.col("view") / F.col("click") * 2, 2))
    summary = F.struct(
        speedup.alias("speedup_factor"),
        F.round(F.abs(F.col("purchase") - F.col("signup")) / 2, 2).alias("f1_degradation_pct"),
        F.round(F.col("small") * 100, 1).alias("sparsity_pct"),
        F.round("highest", 2).alias("latency_ms"),
    )
    results = F.struct(
        F.struct(F.round(F.col("click") / 100, 4).alias("macro_f1")).alias("baseline_fp32"),
        F.struct(
            F.round(F.col("view") / 100, 4).alias("macro_f1"),
            F.round(F.col("view") / F.col("click"), 2).alias("speedup_factor"),
        ).alias("quantized_int8"),
        F.struct(F.round(F.col("view") / F.col("click") * 3, 2).alias("speedup_factor")).alias("pruned"),
    )
    optimization = days.select(
        "run_id",
        F.to_json(
            F.struct(F.lit("compression").alias("kind"), results.alias("results"), summary.alias("summary"))
        ).alias("report"),
    )
    kept = F.struct(
        F.round(100 - F.abs(F.col("error") - F.col("view")) * 2, 1).alias("f1_retention_pct"),
        F.round(F.col("error") / F.col("view"), 2).alias("speedup_factor"),
    )
    distillation = days.filter(F.col("run_id") % 5 != 0).select(
        "run_id", F.to_json(F.struct(kept.alias("summary"))).alias("report")
    )
    return optimization, distillation


def long_report(spark: SparkSession, sf: str) -> DataFrame:
    optimization, distillation = reports(spark, sf)
    combined = rg.combine_reports(
        {
            "optimization": files.flatten_reports(optimization),
            "distillation": files.flatten_reports(distillation),
        }
    )
    return via_table(combined, "reports")


LONG = f"""{DAILY},
long AS (
  SELECT run_id, 'optimization' AS component, 'summary' AS variant, 'speedup_factor' AS metric,
    round(view / click * 2, 2) AS value FROM daily WHERE run_id % 7 <> 0
  UNION ALL SELECT run_id, 'optimization', 'summary', 'f1_degradation_pct', round(abs(purchase - signup) / 2, 2) FROM daily
  UNION ALL SELECT run_id, 'optimization', 'summary', 'sparsity_pct', round(small * 100, 1) FROM daily
  UNION ALL SELECT run_id, 'optimization', 'summary', 'latency_ms', round(highest, 2) FROM daily
  UNION ALL SELECT run_id, 'optimization', 'baseline_fp32', 'macro_f1', round(click / 100, 4) FROM daily
  UNION ALL SELECT run_id, 'optimization', 'quantized_int8', 'macro_f1', round(view / 100, 4) FROM daily
  UNION ALL SELECT run_id, 'optimization', 'quantized_int8', 'speedup_factor', round(view / click, 2) FROM daily
  UNION ALL SELECT run_id, 'optimization', 'pruned', 'speedup_factor', round(view / click * 3, 2) FROM daily
  UNION ALL SELECT run_id, 'distillation', 'summary', 'speedup_factor', round(error / view, 2)
    FROM daily WHERE run_id % 5 <> 0
  UNION ALL SELECT run_id, 'distillation', 'summary', 'f1_retention_pct', round(100 - abs(error - view) * 2, 1)
    FROM daily WHERE run_id % 5 <> 0)"""


@query("s05_read_reports", f"WITH {LONG} SELECT run_id, component, variant, metric, value FROM long")
def s05(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "reports")
    for name, frame in zip(("optimization", "distillation"), reports(spark, sf)):
        frame.withColumnRenamed("report", "value").write.partitionBy("run_id").text(f"{root}/{name}")
    paths = {c: f"{root}/{c}" for c in ("optimization", "distillation", "distributed")}
    rows = files.read_reports(spark, paths)
    return rows.withColumn("run_id", F.regexp_extract("path", r"run_id=(\d+)", 1).cast("int")).drop("path")


def sql_findings(with_latency: bool = False) -> str:
    """Findings from the literal limits, one branch per threshold."""
    branches = []
    for x in rg.THRESHOLDS:
        if x.optional and not with_latency:
            continue
        value = "coalesce(value, 0)"
        broken = f"{value} {'>' if x.op == 'max' else '<'} {x.limit}"
        branches.append(
            f"""SELECT p.run_id, '{x.shown_component}' AS component, '{x.shown_metric}' AS metric,
      '{x.metric}' AS metric_key, '{x.component}' AS component_key, coalesce(variant, 'summary') AS variant_key,
      printf('{x.shown_value}', {value}) AS value, '{x.limit}{x.unit}' AS threshold,
      CASE WHEN {broken} THEN '{x.severity}' ELSE 'OK' END AS severity,
      CASE WHEN {broken} THEN printf('{x.breach}', {value}) ELSE printf('{x.fine}', {value}) END AS message,
      CASE WHEN {broken} THEN {x.status_effect} ELSE 0 END AS status_effect
    FROM (SELECT DISTINCT run_id, component FROM long) p LEFT JOIN (
        SELECT run_id, component, coalesce(max(value) FILTER (variant = 'summary'), {x.op}(value)) AS value,
          CASE WHEN count(*) FILTER (variant = 'summary') > 0 THEN 'summary' ELSE arg_{x.op}(variant, value) END AS variant
        FROM long WHERE metric = '{x.metric}' GROUP BY run_id, component) l
      ON l.run_id = p.run_id AND l.component = p.component
    WHERE p.component = '{x.component}'"""
        )
    return "findings AS (" + " UNION ALL ".join(branches) + ")"


FINDINGS = f"WITH {LONG}, {sql_findings()}"


def findings(spark: SparkSession, sf: str) -> DataFrame:
    return rg.find_regressions(long_report(spark, sf), ["run_id"])


@query(
    "r01_thresholds",
    f"""WITH {LONG}, limits(name, component, metric, op, "limit", severity, status_effect, optional) AS (VALUES {', '.join(
        f"('{x.name}', '{x.component}', '{x.metric}', '{x.op}', CAST({x.limit} AS DOUBLE), '{x.severity}', {x.status_effect}, {x.optional})"
        for x in rg.THRESHOLDS)})
    SELECT t.name, t.op, t."limit", t.severity, t.status_effect, t.optional, count(l.value) AS reported
    FROM limits t LEFT JOIN long l ON l.component = t.component AND l.metric = t.metric GROUP BY ALL""",
)
def r01(spark: SparkSession, sf: str) -> DataFrame:
    """Each limit with the number of reports that state its metric."""
    stated = long_report(spark, sf).groupBy("component", "metric").agg(F.count("value").alias("reported"))
    table = rg.threshold_table(spark).join(stated, ["component", "metric"], "left")
    return table.select(
        "name", "op", "limit", "severity", "status_effect", "optional",
        F.coalesce("reported", F.lit(0)).alias("reported"),
    )


@query("r02_find_regressions", f"{FINDINGS} SELECT * FROM findings")
def r02(spark: SparkSession, sf: str) -> DataFrame:
    return findings(spark, sf)


@query("r02_find_regressions_latency", f"WITH {LONG}, {sql_findings(True)} SELECT * FROM findings")
def r02_latency(spark: SparkSession, sf: str) -> DataFrame:
    return rg.find_regressions(long_report(spark, sf), ["run_id"], check_latency=True)


@query(
    "r03_overall_status",
    f"""{FINDINGS} SELECT run_id, CASE max(status_effect) WHEN 2 THEN 'FAIL' WHEN 1 THEN 'WARN' ELSE 'PASS' END
      AS overall_status, count(*) AS findings FROM findings GROUP BY run_id""",
)
def r03(spark: SparkSession, sf: str) -> DataFrame:
    return rg.overall_status(findings(spark, sf), ["run_id"])


@query(
    "r04_alerts",
    f"""{FINDINGS} SELECT '#ml-alerts' AS channel, run_id, component, metric, value, threshold, severity, message
    FROM findings WHERE severity IN ('HIGH', 'MEDIUM')""",
)
def r04(spark: SparkSession, sf: str) -> DataFrame:
    return rg.alerts(findings(spark, sf))


@query(
    "r04_alert_summary",
    f"""{FINDINGS} SELECT run_id, count(*) FILTER (severity <> 'OK') AS alerts_triggered,
      count(*) FILTER (severity <> 'OK') > 0 AS action_required FROM findings GROUP BY run_id""",
)
def r04_summary(spark: SparkSession, sf: str) -> DataFrame:
    return rg.alert_summary(findings(spark, sf), ["run_id"])


@query(
    "r05_evaluation_summary",
    f"""{FINDINGS}
    SELECT l.run_id, l.component, l.variant, l.metric,
      CASE WHEN l.metric LIKE '%\\_f1' ESCAPE '\\' THEN printf('%.2f%%', round(l.value * 100, 2))
        WHEN l.metric LIKE '%\\_ms' ESCAPE '\\' THEN printf('%.2f ms', round(l.value, 2))
        WHEN l.metric LIKE 'speedup%' THEN printf('%.2fx', round(l.value, 2))
        WHEN l.metric LIKE '%\\_pct' ESCAPE '\\' THEN printf('%.2f%%', round(l.value, 2)) END AS shown,
      round(l.value - lag(l.value) OVER (PARTITION BY l.component, l.variant, l.metric ORDER BY l.run_id), 6) AS change,
      f.severity, f.message
    FROM long l LEFT JOIN findings f ON f.run_id = l.run_id AND f.metric_key = l.metric
      AND f.component_key = l.component AND f.variant_key = l.variant""",
)
def r05(spark: SparkSession, sf: str) -> DataFrame:
    report = long_report(spark, sf)
    found = rg.find_regressions(report, ["run_id"])
    return rg.evaluation_summary(report, found, "run_id").withColumn("change", F.round("change", 6))


@query("r06_combine_reports", f"WITH {LONG} SELECT run_id, component, variant, metric, value FROM long")
def r06(spark: SparkSession, sf: str) -> DataFrame:
    return long_report(spark, sf)
