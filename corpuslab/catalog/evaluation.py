"""Queries over predictions, latencies, logits and metric reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpuslab.functions.numbers import half_up
from corpuslab.operators import evaluate as ev
from corpuslab.session import via_table

from . import tables as t, tokens as tok
from .registry import registry

QUERIES, ORACLES, query = registry()

def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    return df.select(*[half_up(c, places).alias(c) if kind == "double" else c for c, kind in df.dtypes])


MODELS = {"A": "pred_a", "B": "pred_b"}


def pairs(spark: SparkSession, sf: str, keys: list[str] | None = None) -> DataFrame:
    return ev.prediction_pairs(tok.predictions(spark, sf), keys or [], MODELS)


@query("e01_prediction_pairs", f"WITH {tok.PAIRS} SELECT model, sample_id, position, gold, pred FROM pairs")
def e01(spark: SparkSession, sf: str) -> DataFrame:
    return pairs(spark, sf, ["sample_id"])


@query("e02_confusion", f"WITH {tok.PAIRS} SELECT model, gold, pred, count(*) AS n FROM pairs GROUP BY ALL")
def e02(spark: SparkSession, sf: str) -> DataFrame:
    return ev.confusion(pairs(spark, sf), ["model"])


def sql_report(by: str, name: str = "report") -> str:
    """Classes seen per group, with the counts behind precision and recall."""
    return f"""{name} AS (
  SELECT {by}, label, sum(hit) AS hit, sum(support) AS support, sum(predicted) AS predicted,
    coalesce(2.0 * sum(hit) / nullif(sum(support) + sum(predicted), 0), 0) AS f1
  FROM (
    SELECT {by}, gold AS label, CASE WHEN gold = pred THEN 1 ELSE 0 END AS hit, 1 AS support, 0 AS predicted FROM pairs
    UNION ALL SELECT {by}, pred, 0, 0, 1 FROM pairs)
  GROUP BY {by}, label)"""


REPORT = f"WITH {tok.PAIRS}, {sql_report('model')}"


@query(
    "e03_classification_report",
    f"""{REPORT}
    SELECT model, CAST(label AS INTEGER) AS label, round(coalesce(hit / nullif(predicted, 0), 0), 6) AS precision,
      round(coalesce(hit / nullif(support, 0), 0), 6) AS recall, round(f1, 6) AS f1, CAST(support AS BIGINT) AS support
    FROM (
      SELECT m.model, l.label, coalesce(hit, 0) AS hit, coalesce(support, 0) AS support,
        coalesce(predicted, 0) AS predicted, coalesce(f1, 0) AS f1
      FROM (VALUES ('A'), ('B')) m(model) CROSS JOIN range(5) l(label)
      LEFT JOIN report r ON r.model = m.model AND r.label = l.label)""",
)
def e03(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(ev.classification_report(pairs(spark, sf), ["model"], ev.LABEL_IDS))


@query(
    "e04_macro_f1",
    f"""{REPORT} SELECT model, round(avg(f1), 6) AS macro_f1, round(sum(f1) / 5, 6) AS macro_f1_fixed
    FROM report GROUP BY model""",
)
def e04(spark: SparkSession, sf: str) -> DataFrame:
    rows = pairs(spark, sf)
    seen = ev.macro_f1(ev.classification_report(rows, ["model"]), ["model"])
    fixed = ev.macro_f1(ev.classification_report(rows, ["model"], ev.LABEL_IDS), ["model"])
    return rounded(seen.join(fixed.withColumnRenamed("macro_f1", "macro_f1_fixed"), "model"))


@query(
    "e05_weighted_f1",
    f"{REPORT} SELECT model, round(sum(f1 * support) / sum(support), 6) AS weighted_f1 FROM report GROUP BY model",
)
def e05(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(ev.weighted_f1(ev.classification_report(pairs(spark, sf), ["model"], ev.LABEL_IDS), ["model"]))


@query(
    "e06_entity_f1",
    f"""{REPORT} SELECT model, round(coalesce(max(f1) FILTER (label = 1), 0), 6) AS chemical_f1,
      round(coalesce(max(f1) FILTER (label = 3), 0), 6) AS disease_f1 FROM report GROUP BY model""",
)
def e06(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(ev.entity_f1(ev.classification_report(pairs(spark, sf), ["model"], ev.LABEL_IDS), ["model"]))


@query(
    "e07_token_accuracy",
    f"""WITH {tok.PAIRS} SELECT model, count(*) AS tokens,
      round(avg(CASE WHEN gold = pred THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM pairs GROUP BY model""",
)
def e07(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(ev.token_accuracy(pairs(spark, sf), ["model"]))


@query(
    "e08_entity_accuracy",
    f"""WITH {tok.PAIRS} SELECT model, count(*) AS tokens,
      round(avg(CASE WHEN gold = pred THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM pairs WHERE gold <> 0 GROUP BY model""",
)
def e08(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(ev.token_accuracy(pairs(spark, sf), ["model"], entities_only=True))


@query(
    "e07_sample_metrics",
    f"""WITH {tok.PAIRS}, {sql_report('sample_id, model')},
    hits AS (SELECT sample_id, model, count(*) AS num_tokens, count(*) FILTER (gold = pred) AS correct
             FROM pairs GROUP BY ALL),
    scores AS (
      SELECT sample_id, model, avg(f1) AS macro_f1, sum(f1) / 5 AS macro_f1_fixed,
        sum(f1 * support) / sum(support) AS weighted_f1,
        coalesce(max(f1) FILTER (label = 1), 0) AS chemical_f1, coalesce(max(f1) FILTER (label = 3), 0) AS disease_f1
      FROM report GROUP BY sample_id, model)
    SELECT sample_id, model, num_tokens, correct, {t.sql_half_up('correct / num_tokens', 6)} AS accuracy,
      {t.sql_half_up('macro_f1', 6)} AS macro_f1, {t.sql_half_up('macro_f1_fixed', 6)} AS macro_f1_fixed,
      {t.sql_half_up('weighted_f1', 6)} AS weighted_f1, {t.sql_half_up('chemical_f1', 6)} AS chemical_f1, {t.sql_half_up('disease_f1', 6)} AS disease_f1
    FROM hits JOIN scores USING (sample_id, model)""",
)
def e07_samples(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(ev.sample_metrics(tok.predictions(spark, sf), ["sample_id"], {"A": "pred_a", "B": "pred_b"}))


# ---- latency

RUNS = """runs AS (
  SELECT event_id AS seq, 'v' || CAST(user_id % 2 AS VARCHAR) AS model, value AS latency_ms FROM events)"""


def runs(spark: SparkSession, sf: str) -> DataFrame:
    model = F.concat(F.lit("v"), F.pmod("user_id", F.lit(2)).cast("string"))
    return t.table(spark, sf, "events").select(
        F.col("event_id").alias("seq"), model.alias("model"), F.col("value").alias("latency_ms")
    )


def sql_profile(value: str = "latency_ms") -> str:
    return f"""count(*) AS runs, round(avg({value}), 6) AS mean, round(stddev_pop({value}), 6) AS std,
      round(quantile_cont({value}, 0.5), 6) AS p50, round(quantile_cont({value}, 0.95), 6) AS p95,
      round(quantile_cont({value}, 0.99), 6) AS p99"""


@query("e09_latency_profile", f"WITH {RUNS} SELECT model, {sql_profile()} FROM runs GROUP BY model")
def e09(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(ev.latency_profile(runs(spark, sf), ["model"]))


@query(
    "e10_skip_warmup",
    f"""WITH {RUNS} SELECT model, seq, latency_ms
    FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY seq) AS i FROM runs) WHERE i > 10""",
)
def e10(spark: SparkSession, sf: str) -> DataFrame:
    return ev.skip_warmup(runs(spark, sf), ["model"], "seq", 10).select("model", "seq", "latency_ms")


BATCHES = "batches AS (SELECT *, 1 + seq % 16 AS batch_rows FROM runs)"


@query(
    "e11_per_sample_latency",
    f"""WITH {RUNS}, {BATCHES}, samples AS (SELECT model, latency_ms / batch_rows AS per_sample FROM batches)
    SELECT model, {sql_profile('per_sample')} FROM samples GROUP BY model""",
)
def e11(spark: SparkSession, sf: str) -> DataFrame:
    batches = runs(spark, sf).select(
        "model", F.col("latency_ms").alias("batch_ms"), (F.pmod("seq", F.lit(16)) + 1).alias("batch_rows")
    )
    return rounded(ev.latency_profile(ev.per_sample_latency(batches), ["model"]))


@query(
    "e12_size_report",
    """SELECT label, CAST(sum(len(embedding)) AS BIGINT) AS parameters,
      round(sum(len(embedding) * 4) / 1048576, 6) AS model_size_mb FROM embeddings GROUP BY label""",
)
def e12(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(ev.size_report(t.table(spark, sf, "embeddings"), ["label"], "embedding"))


# ---- reports of three variants: teacher (gold rule, all vectors), A and B

VARIANTS = f"""{REPORT}, {RUNS},
quality AS (SELECT model AS variant, avg(f1) AS macro_f1 FROM report GROUP BY model),
speed AS (
  SELECT CASE model WHEN 'v0' THEN 'A' ELSE 'B' END AS variant, avg(latency_ms) AS latency_mean_ms,
    quantile_cont(latency_ms, 0.95) AS latency_p95_ms FROM runs GROUP BY model),
weights AS (
  SELECT CASE WHEN label < 7 THEN 'A' ELSE 'B' END AS variant, sum(len(embedding)) AS parameters
  FROM embeddings GROUP BY 1),
wide AS (SELECT * FROM quality JOIN speed USING (variant) JOIN weights USING (variant))"""


def variants(spark: SparkSession, sf: str) -> DataFrame:
    """Wide metrics of the variants A and B."""
    quality = ev.macro_f1(ev.classification_report(pairs(spark, sf), ["model"]), ["model"])
    quality = quality.withColumnRenamed("model", "variant")
    name = F.when(F.col("model") == "v0", "A").otherwise("B")
    speed = ev.latency_profile(runs(spark, sf).withColumn("variant", name), ["variant"]).select(
        "variant", F.col("mean").alias("latency_mean_ms"), F.col("p95").alias("latency_p95_ms")
    )
    vectors = t.table(spark, sf, "embeddings").withColumn("variant", F.when(F.col("label") < 7, "A").otherwise("B"))
    weights = ev.size_report(vectors, ["variant"], "embedding").drop("model_size_mb")
    return quality.join(speed, "variant").join(weights, "variant")


def report(spark: SparkSession, sf: str) -> DataFrame:
    return via_table(ev.long_report(variants(spark, sf), ["variant"]), "report")


@query(
    "e13_compare_to_baseline",
    f"""{VARIANTS}
    SELECT b.variant, round(b.macro_f1 / a.macro_f1 * 100, 6) AS f1_retention_pct,
      round((1 - b.parameters / a.parameters) * 100, 6) AS param_reduction_pct,
      round(a.latency_mean_ms / b.latency_mean_ms, 6) AS speedup,
      round(a.parameters / b.parameters, 6) AS compression_ratio
    FROM wide a, wide b WHERE a.variant = 'A' AND b.variant = 'B'""",
)
def e13(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(ev.compare_to_baseline(report(spark, sf), "A"))


@query(
    "e14_delta_table",
    f"""{VARIANTS},
    long AS (UNPIVOT (SELECT variant, CAST(macro_f1 AS DOUBLE) AS macro_f1,
        CAST(latency_mean_ms AS DOUBLE) AS latency_mean_ms, CAST(latency_p95_ms AS DOUBLE) AS latency_p95_ms,
        CAST(parameters AS DOUBLE) AS parameters FROM wide)
      ON macro_f1, latency_mean_ms, latency_p95_ms, parameters INTO NAME metric VALUE value),
    sides AS (SELECT metric, max(value) FILTER (variant = 'A') AS f, max(value) FILTER (variant = 'B') AS s
              FROM long GROUP BY metric)
    SELECT metric, round(f, 6) AS first, round(s, 6) AS second, round(s - f, 6) AS delta,
      printf('%+.2f', round((s - f) * 100, 2)) AS points FROM sides""",
)
def e14(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(ev.delta_table(report(spark, sf), "A", "B"))


@query(
    "e15_target_checks",
    f"""{VARIANTS},
    zeros AS (SELECT avg(CASE WHEN abs(x) < 0.05 THEN 1.0 ELSE 0.0 END) AS sparsity
              FROM (SELECT unnest(embedding) AS x FROM embeddings)),
    summary AS (
      SELECT a.latency_mean_ms / b.latency_mean_ms AS speedup, a.macro_f1 - b.macro_f1 AS f1_drop, sparsity,
        b.latency_p95_ms FROM wide a, wide b, zeros WHERE a.variant = 'A' AND b.variant = 'B')
    SELECT round(speedup, 6) AS speedup, round(f1_drop, 6) AS f1_drop, round(sparsity, 6) AS sparsity,
      round(latency_p95_ms, 6) AS latency_p95_ms, speedup >= 2.5 AS speedup_met, f1_drop < 0.02 AS f1_drop_met,
      sparsity >= 0.38 AS sparsity_met, latency_p95_ms < 20 AS latency_met FROM summary""",
)
def e15(spark: SparkSession, sf: str) -> DataFrame:
    vectors = t.table(spark, sf, "embeddings")
    near_zero = F.sum(F.size(F.filter("embedding", lambda x: F.abs(x) < 0.05)))
    sparsity = vectors.agg((near_zero / F.sum(F.size("embedding"))).alias("sparsity"))

    def of(variant: str, metric: str):
        return F.max(F.when((F.col("variant") == variant) & (F.col("metric") == metric), F.col("value")))

    summary = report(spark, sf).agg(
        (of("A", "latency_mean_ms") / of("B", "latency_mean_ms")).alias("speedup"),
        (of("A", "macro_f1") - of("B", "macro_f1")).alias("f1_drop"),
        of("B", "latency_p95_ms").alias("latency_p95_ms"),
    )
    return rounded(ev.target_checks(summary.withColumn("sparsity", sparsity.scalar())))


@query(
    "e16_variant_summary",
    f"""{VARIANTS} SELECT variant, round(macro_f1, 6) AS macro_f1, round(latency_mean_ms, 6) AS latency_mean_ms,
      round(latency_p95_ms, 6) AS latency_p95_ms, CAST(parameters AS DOUBLE) AS parameters FROM wide""",
)
def e16(spark: SparkSession, sf: str) -> DataFrame:
    metrics = ["macro_f1", "latency_mean_ms", "latency_p95_ms", "parameters"]
    return rounded(ev.variant_summary(report(spark, sf), [], metrics))


# ---- training histories: one run per user, one epoch per day

HISTORY = """history AS (
  SELECT user_id AS run, CAST(dayofyear(ts) AS INTEGER) AS epoch,
    least(CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) / 1000, 1.0) AS val_macro_f1
  FROM events GROUP BY ALL)"""


def history(spark: SparkSession, sf: str) -> DataFrame:
    total = F.sum(F.col("value").cast("decimal(18,2)")).cast("double") / 1000
    return (
        t.table(spark, sf, "events")
        .groupBy(F.col("user_id").alias("run"), F.dayofyear("ts").alias("epoch"))
        .agg(F.least(total, F.lit(1.0)).alias("val_macro_f1"))
    )


@query(
    "e17_select_checkpoint",
    f"""WITH RECURSIVE {HISTORY},
    numbered AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY epoch) AS i FROM history),
    fold(run, i, best_epoch, best, best_i, wait) AS (
      SELECT DISTINCT run, CAST(0 AS BIGINT), CAST(NULL AS INTEGER), CAST(0 AS DOUBLE), CAST(0 AS BIGINT),
        CAST(0 AS BIGINT) FROM history
      UNION ALL
      SELECT f.run, n.i,
        CASE WHEN n.val_macro_f1 > f.best + 0.001 THEN n.epoch ELSE f.best_epoch END,
        CASE WHEN n.val_macro_f1 > f.best + 0.001 THEN n.val_macro_f1 ELSE f.best END,
        CASE WHEN n.val_macro_f1 > f.best + 0.001 THEN n.i ELSE f.best_i END,
        CASE WHEN n.val_macro_f1 > f.best + 0.001 THEN 0 ELSE f.wait + 1 END
      FROM fold f JOIN numbered n ON n.run = f.run AND n.i = f.i + 1 WHERE f.wait < 3)
    SELECT run, arg_max(best_epoch, i) AS best_epoch, arg_max(best, i) AS best_value, max(i) AS epochs_run,
      arg_max(wait, i) >= 3 AS stopped_early
    FROM fold GROUP BY run""",
)
def e17(spark: SparkSession, sf: str) -> DataFrame:
    return ev.select_checkpoint(via_table(history(spark, sf), "history"), ["run"])


# ---- distillation


@query(
    "e18_distillation_loss",
    f"""WITH {tok.LOGITS},
    scaled AS (
      SELECT sample_id, gold, [x / 4 for x in teacher] AS t, [x / 4 for x in student] AS s, student AS h
      FROM logits WHERE gold <> -100),
    totals AS (SELECT *, ln(list_sum([exp(x) for x in t])) AS lt, ln(list_sum([exp(x) for x in s])) AS ls,
                 ln(list_sum([exp(x) for x in h])) AS lh FROM scaled),
    tokens AS (
      SELECT sample_id, list_sum([exp(t[k] - lt) * ((t[k] - lt) - (s[k] - ls)) for k in range(1, 6)]) AS soft,
        lh - h[gold + 1] AS hard FROM totals),
    averaged AS (SELECT sample_id, count(*) AS tokens, avg(soft) * 16 AS soft_loss, avg(hard) AS hard_loss
                 FROM tokens GROUP BY sample_id)
    SELECT sample_id, tokens, round(soft_loss, 6) AS soft_loss, round(hard_loss, 6) AS hard_loss,
      round(soft_loss * 0.5 + hard_loss * 0.5, 6) AS loss FROM averaged""",
)
def e18(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(ev.distillation_loss(tok.logits(spark, sf), ["sample_id"]))


def _sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Pieces of three and of five letters of every word, with their word number."""
    words = tok.word_arrays(spark, sf).select(
        F.col("doc_id").cast("bigint").alias("sample_id"), F.posexplode("words").alias("word_idx", "word")
    )

    def cut(size: int, name: str) -> DataFrame:
        starts = F.sequence(F.lit(0), F.floor((F.length("word") - 1) / size).cast("int"))
        parts = F.transform(starts, lambda i: F.substr("word", i * size + 1, F.lit(size)))
        return words.select(
            "sample_id",
            "word_idx",
            F.posexplode(parts).alias("piece", name),
        ).select("sample_id", "word_idx", (F.col("word_idx") * 100 + F.col("piece")).alias("position"), name)

    return cut(3, "short_piece"), cut(5, "long_piece")


SIDES = f"""{t.CLEAN},
word_rows AS (
  SELECT CAST(doc_id AS BIGINT) AS sample_id, unnest(words) AS word, CAST(unnest(range(len(words))) AS INTEGER) AS word_idx
  FROM (SELECT doc_id, string_split(text_clean, ' ') AS words FROM clean)),
short AS (SELECT sample_id, word_idx, i, word_idx * 100 + i AS position, substr(word, 3 * i + 1, 3) AS short_piece
  FROM (SELECT *, CAST(unnest(range((length(word) - 1) // 3 + 1)) AS INTEGER) AS i FROM word_rows)),
long AS (SELECT sample_id, word_idx, i, word_idx * 100 + i AS position, substr(word, 5 * i + 1, 5) AS long_piece
  FROM (SELECT *, CAST(unnest(range((length(word) - 1) // 5 + 1)) AS INTEGER) AS i FROM word_rows))"""


@query(
    "e19_align_sequences",
    f"""WITH {SIDES}
    SELECT 'word' AS mode, sample_id, word_idx AS spot, short_piece, long_piece
    FROM short JOIN long USING (sample_id, word_idx) WHERE short.i = 0 AND long.i = 0
    UNION ALL
    SELECT 'position', sample_id, position, short_piece, long_piece FROM short JOIN long USING (sample_id, position)""",
)
def e19(spark: SparkSession, sf: str) -> DataFrame:
    short, long = _sides(spark, sf)
    both = ev.side_by_side(short, long)
    by_word = ev.align_by_word(short, long, beside=both).select(
        F.lit("word").alias("mode"), "sample_id", F.col("word_idx").alias("spot"), "short_piece", "long_piece"
    )
    by_spot = ev.align_by_position(short.drop("word_idx"), long.drop("word_idx"), beside=both)
    return by_word.unionByName(
        by_spot.select(
            F.lit("position").alias("mode"), "sample_id", F.col("position").alias("spot"), "short_piece", "long_piece"
        )
    )
