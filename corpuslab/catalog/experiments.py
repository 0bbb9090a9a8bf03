"""Queries over paired experiments; each document source is one experiment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpuslab.functions.stats import EXACT_PAIRS, EXACT_SMALLER
from corpuslab.operators import experiment as ex, ranks
from corpuslab.session import scratch_path, via_table
from corpuslab.sources import files

from . import tables as t, tokens as tok
from .evaluation import rounded, sql_report
from .registry import registry

QUERIES, ORACLES, query = registry()

BY = ["experiment_id"]


def log(spark: SparkSession, sf: str) -> DataFrame:
    arms = tok.predictions(spark, sf).withColumnRenamed("source", "experiment_id")
    result = ex.experiment_log(arms, tok.latencies(spark, sf), ["experiment_id", "sample_id"])
    return via_table(result, "experiment-log")


LOG = f"""WITH {tok.PAIRS}, {sql_report('sample_id, model')}, {tok.LATENCIES},
counts AS (
  SELECT sample_id, any_value(source) AS experiment_id, count(*) FILTER (model = 'A') AS num_tokens,
    count(*) FILTER (model = 'A' AND gold = pred) AS correct_a,
    count(*) FILTER (model = 'B' AND gold = pred) AS correct_b
  FROM pairs GROUP BY sample_id),
scores AS (SELECT sample_id, model, avg(f1) AS f1 FROM report GROUP BY sample_id, model),
log AS (
  SELECT experiment_id, sample_id, {t.sql_half_up('latency_a_ms', 3)} AS latency_a_ms, {t.sql_half_up('latency_b_ms', 3)} AS latency_b_ms,
    {t.sql_half_up('correct_a / num_tokens', 4)} AS accuracy_a, {t.sql_half_up('correct_b / num_tokens', 4)} AS accuracy_b,
    {t.sql_half_up('a.f1', 4)} AS f1_a, {t.sql_half_up('b.f1', 4)} AS f1_b, num_tokens, correct_a, correct_b
  FROM counts JOIN scores a USING (sample_id) JOIN scores b USING (sample_id) JOIN latencies USING (sample_id)
  WHERE a.model = 'A' AND b.model = 'B')"""

LOG_COLUMNS = (
    "sample_id, latency_a_ms, latency_b_ms, accuracy_a, accuracy_b, f1_a, f1_b, num_tokens, correct_a, correct_b"
)


@query(
    "t01_assign_groups",
    """SELECT doc_id AS sample_id,
      CASE WHEN substr(sha256('42:' || CAST(doc_id AS VARCHAR)), 64, 1) IN ('0', '2', '4', '6', '8', 'a', 'c', 'e')
        THEN 'A' ELSE 'B' END AS assigned_group FROM documents""",
)
def t01(spark: SparkSession, sf: str) -> DataFrame:
    docs = t.documents(spark, sf).select(F.col("doc_id").cast("bigint").alias("sample_id"))
    return docs.withColumn("assigned_group", ex.assigned_group(F.col("sample_id")))


@query("t02_experiment_log", f"{LOG} SELECT experiment_id, {LOG_COLUMNS} FROM log")
def t02(spark: SparkSession, sf: str) -> DataFrame:
    return log(spark, sf).drop("assigned_group")


@query("s07_experiment_log_csv", f"{LOG} SELECT {LOG_COLUMNS} FROM log")
def s07(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "experiment-csv")
    files.write_experiment_log(log(spark, sf), path)
    return files.read_experiment_log(spark, path).drop("assigned_group")


@query(
    "t03_first_samples",
    f"{LOG} SELECT experiment_id, {LOG_COLUMNS} FROM log ORDER BY sample_id LIMIT 200",
)
def t03(spark: SparkSession, sf: str) -> DataFrame:
    return ranks.first_n(t02(spark, sf), "sample_id", 200)


@query(
    "t04_mid_rank",
    """SELECT event_id, value, rank() OVER (ORDER BY value) + (count(*) OVER (PARTITION BY value) - 1) / 2 AS mid_rank
    FROM events""",
)
def t04(spark: SparkSession, sf: str) -> DataFrame:
    return ranks.mid_rank(t.table(spark, sf, "events").select("event_id", "value"), "value")


RANK_SUM = f"""{LOG},
stacked AS (
  SELECT experiment_id, 1 AS first, latency_a_ms AS value FROM log
  UNION ALL SELECT experiment_id, 0, latency_b_ms FROM log),
ranked AS (
  SELECT *, rank() OVER (PARTITION BY experiment_id ORDER BY value)
    + (count(*) OVER (PARTITION BY experiment_id, value) - 1) / 2 AS r,
    count(*) OVER (PARTITION BY experiment_id, value) AS tied FROM stacked),
sums AS (
  SELECT experiment_id, sum(first) AS n_a, count(*) - sum(first) AS n_b, sum(r) FILTER (first = 1) AS rs,
    CAST(sum(tied * tied - 1) AS DOUBLE) AS ties
  FROM ranked GROUP BY experiment_id),
rank_sum AS (
  SELECT experiment_id, CAST(n_a AS BIGINT) AS n_a, CAST(n_b AS BIGINT) AS n_b,
    rs - n_a * (n_a + 1) / 2 AS u_statistic, ties,
    (greatest(rs - n_a * (n_a + 1) / 2, n_a * n_b - rs + n_a * (n_a + 1) / 2) - n_a * n_b / 2 - 0.5)
      / sqrt(n_a * n_b / 12 * (n_a + n_b + 1 - ties / ((n_a + n_b) * (n_a + n_b - 1)))) AS z
  FROM sums)"""


@query("t05_mann_whitney", f"{RANK_SUM} SELECT experiment_id, n_a, n_b, u_statistic, ties, round(z, 6) AS z FROM rank_sum")
def t05(spark: SparkSession, sf: str) -> DataFrame:
    tested = ex.mann_whitney(log(spark, sf), BY, "latency_a_ms", "latency_b_ms")
    return tested.drop("p_value").withColumn("z", F.round("z", 6))


@query("t05_rank_sum_p")
def t05_p(spark: SparkSession, sf: str) -> DataFrame:
    return ex.mann_whitney(log(spark, sf), BY, "latency_a_ms", "latency_b_ms")


@query(
    "t05_rank_sum_significant",
    f"""{RANK_SUM} SELECT experiment_id, CASE WHEN least(n_a, n_b) > {EXACT_SMALLER} OR ties > 0
      THEN z > 1.959964 END AS significant FROM rank_sum""",
)
def t05_significant(spark: SparkSession, sf: str) -> DataFrame:
    """Of the tests that use the normal tail; z is never negative but for the continuity correction."""
    tested = ex.mann_whitney(log(spark, sf), BY, "latency_a_ms", "latency_b_ms")
    normal = (F.least("n_a", "n_b") > EXACT_SMALLER) | (F.col("ties") > 0)
    return tested.select("experiment_id", F.when(normal, ex.significant(F.col("p_value"))).alias("significant"))


@query(
    "t06_mean_interval",
    f"""{LOG} SELECT experiment_id, count(*) AS num_samples, round(avg(latency_a_ms), 6) AS mean_a,
      round(avg(latency_b_ms), 6) AS mean_b, round(avg(latency_a_ms - latency_b_ms), 6) AS mean_difference,
      round(stddev_samp(latency_a_ms - latency_b_ms) / sqrt(count(*)), 6) AS sem FROM log GROUP BY experiment_id""",
)
def t06(spark: SparkSession, sf: str) -> DataFrame:
    spread = ex.mean_interval(log(spark, sf), BY, "latency_a_ms", "latency_b_ms")
    return rounded(spread.drop("ci_low", "ci_high"))


SIGNED_CTES = """apart AS (SELECT experiment_id, f1_a - f1_b AS d FROM log WHERE f1_a - f1_b <> 0),
ranked_f1 AS (
  SELECT *, rank() OVER (PARTITION BY experiment_id ORDER BY abs(d))
    + (count(*) OVER (PARTITION BY experiment_id, abs(d)) - 1) / 2 AS r,
    count(*) OVER (PARTITION BY experiment_id, abs(d)) AS tied FROM apart),
signed AS (
  SELECT experiment_id, count(*) AS pairs, coalesce(sum(r) FILTER (d > 0), 0) AS w_plus,
    coalesce(sum(r) FILTER (d < 0), 0) AS w_minus, CAST(sum(tied * tied - 1) AS DOUBLE) AS ties
  FROM ranked_f1 GROUP BY experiment_id HAVING count(*) > 10)"""
SIGNED = f"{LOG}, {SIGNED_CTES}"


@query(
    "t07_wilcoxon",
    f"""{SIGNED} SELECT experiment_id, pairs, w_plus, w_minus, least(w_plus, w_minus) AS w_statistic, ties,
      round((least(w_plus, w_minus) - pairs * (pairs + 1) / 4)
        / sqrt((pairs * (pairs + 1) * (2 * pairs + 1) - ties / 2) / 24), 6) AS z FROM signed""",
)
def t07(spark: SparkSession, sf: str) -> DataFrame:
    tested = ex.wilcoxon(log(spark, sf), BY, "f1_a", "f1_b")
    return tested.drop("p_value").withColumn("z", F.round("z", 6))


@query(
    "t07_signed_rank_significant",
    f"""{SIGNED}, scored AS (SELECT experiment_id, pairs, ties, (least(w_plus, w_minus) - pairs * (pairs + 1) / 4)
        / sqrt((pairs * (pairs + 1) * (2 * pairs + 1) - ties / 2) / 24) AS z FROM signed)
    SELECT experiment_id, CASE WHEN pairs > {EXACT_PAIRS} OR ties > 0 THEN abs(z) > 1.959964 END AS significant
    FROM scored""",
)
def t07_significant(spark: SparkSession, sf: str) -> DataFrame:
    """Of the tests that use the normal tail."""
    tested = ex.wilcoxon(log(spark, sf), BY, "f1_a", "f1_b")
    normal = (F.col("pairs") > EXACT_PAIRS) | (F.col("ties") > 0)
    return tested.select("experiment_id", F.when(normal, ex.significant(F.col("p_value"))).alias("significant"))


@query("t07_signed_rank_p")
def t07_p(spark: SparkSession, sf: str) -> DataFrame:
    return ex.wilcoxon(log(spark, sf), BY, "f1_a", "f1_b")


WINNERS = """CASE WHEN d > 0 THEN 'B' WHEN d < 0 THEN 'A' ELSE 'tie' END"""


@query(
    "t08_winner",
    f"""{LOG}, means AS (
      SELECT experiment_id, avg(latency_a_ms - latency_b_ms) AS d, avg(f1_a - f1_b) AS q FROM log GROUP BY experiment_id)
    SELECT experiment_id, {WINNERS} AS latency_winner,
      CASE WHEN d > 0 THEN 'A' WHEN d < 0 THEN 'B' ELSE 'tie' END AS latency_winner_compat,
      CASE WHEN q > 0.001 THEN 'A' WHEN q < -0.001 THEN 'B' ELSE 'tie' END AS f1_winner FROM means""",
)
def t08(spark: SparkSession, sf: str) -> DataFrame:
    means = log(spark, sf).groupBy(*BY).agg(
        F.avg(F.col("latency_a_ms") - F.col("latency_b_ms")).alias("d"), F.avg(F.col("f1_a") - F.col("f1_b")).alias("q")
    )
    return means.select(
        *BY,
        ex.winner(F.col("d"), lower_is_better=True).alias("latency_winner"),
        ex.winner(F.col("d"), lower_is_better=True, compat=True).alias("latency_winner_compat"),
        ex.winner(F.col("q"), lower_is_better=False, band=ex.TIE_BAND).alias("f1_winner"),
    )


def _sql_bands() -> str:
    cases = []
    for limit, template in ex.BANDS:
        shown = t.sql_half_up("r", 1)
        values = f"{shown}, {t.sql_half_up('faster', 1)}" if template.count("%.1f") == 2 else shown
        text = f"printf('{template}', {values})"
        cases.append(f"ELSE {text}" if limit is None else f"WHEN r >= {limit} THEN {text}")
    return "CASE " + " ".join(cases) + " END"


@query(
    "t09_verdict",
    f"""{LOG}, means AS (
      SELECT experiment_id, count(*) AS num_samples, {t.sql_half_up('avg(f1_a)', 4)} AS a, {t.sql_half_up('avg(f1_b)', 4)} AS b,
        {t.sql_half_up('avg(latency_a_ms - latency_b_ms)', 2)} AS faster FROM log GROUP BY experiment_id),
    kept AS (SELECT *, CASE WHEN a <> 0 THEN b / a ELSE 0 END * 100 AS r FROM means)
    SELECT experiment_id, num_samples, {t.sql_half_up('r', 1)} AS f1_retention_pct, {_sql_bands()} AS recommendation FROM kept""",
)
def t09(spark: SparkSession, sf: str) -> DataFrame:
    return ex.ab_verdict(log(spark, sf), BY)


@query(
    "t10_ab_report",
    f"""{RANK_SUM}, {SIGNED_CTES},
    means AS (
      SELECT experiment_id, count(*) AS num_samples, avg(latency_a_ms) AS la, avg(latency_b_ms) AS lb,
        avg(latency_a_ms - latency_b_ms) AS ld, avg(f1_a) AS fa, avg(f1_b) AS fb, avg(f1_a - f1_b) AS fd
      FROM log GROUP BY experiment_id)
    SELECT experiment_id, 'latency' AS metric, 'Mann-Whitney U' AS test, num_samples, {t.sql_half_up('la', 2)} AS mean_a,
      {t.sql_half_up('lb', 2)} AS mean_b, {t.sql_half_up('ld', 2)} AS mean_difference, round(u_statistic, 2) AS statistic,
      CASE WHEN ld > 0 THEN 'B' WHEN ld < 0 THEN 'A' ELSE 'tie' END AS winner
    FROM means JOIN rank_sum USING (experiment_id)
    UNION ALL
    SELECT experiment_id, 'f1_score', 'Wilcoxon signed-rank', num_samples, {t.sql_half_up('fa', 4)}, {t.sql_half_up('fb', 4)},
      {t.sql_half_up('fd', 4)},
      round(coalesce(least(w_plus, w_minus), 0), 2),
      CASE WHEN fd > 0.001 THEN 'A' WHEN fd < -0.001 THEN 'B' ELSE 'tie' END
    FROM means LEFT JOIN signed USING (experiment_id)""",
)
def t10(spark: SparkSession, sf: str) -> DataFrame:
    return ex.ab_report(log(spark, sf), BY).drop("ci_low", "ci_high", "p_value", "significant")


@query("t10_ab_report_full")
def t10_full(spark: SparkSession, sf: str) -> DataFrame:
    return ex.ab_report(log(spark, sf), BY)


@query(
    "t11_run_means",
    f"""{LOG}, means AS (
      SELECT experiment_id, avg(latency_a_ms) AS la, avg(latency_b_ms) AS lb, avg(f1_a) AS fa, avg(f1_b) AS fb
      FROM log GROUP BY experiment_id)
    SELECT experiment_id, 'A' AS arm, 'latency_ms' AS metric, round(la, 6) AS value FROM means
    UNION ALL SELECT experiment_id, 'B', 'latency_ms', round(lb, 6) FROM means
    UNION ALL SELECT experiment_id, 'A', 'f1_pct', round(fa * 100, 6) FROM means
    UNION ALL SELECT experiment_id, 'B', 'f1_pct', round(fb * 100, 6) FROM means""",
)
def t11(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(ex.run_means(log(spark, sf), BY))
