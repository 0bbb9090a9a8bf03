"""Queries over request logs; the events table is the log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpuslab.functions.numbers import half_up
from corpuslab.operators import requests as req, sketches
from corpuslab.operators.skew import join_keys
from corpuslab.operators.spans import stage_durations
from corpuslab.session import scratch_path, via_table
from corpuslab.sources import files, sinks
from corpuslab.streaming import requests as live
from corpuslab.streaming.late import accounted, late_counts, write_late_counts
from corpuslab.streaming.stateful import active_requests_stream, ordered_session_numbers, rocksdb_state

from . import tables as t, tokens as tok
from .registry import registry

QUERIES, ORACLES, query = registry()

def as_log(events: DataFrame, *keep: str) -> DataFrame:
    """Events as log rows: errors carry a type, answered requests a latency, entities and a length."""
    failed = F.col("event_type") == "error"
    user = F.col("user_id")

    def answered(value: Column) -> Column:
        return F.when(~failed, value)

    counts = F.map_filter(
        F.create_map(
            F.lit("Chemical"),
            F.pmod(user, F.lit(4)).cast("int"),
            F.lit("Disease"),
            F.pmod(user, F.lit(3)).cast("int"),
        ),
        lambda _, n: n > 0,
    )
    return events.select(
        *keep,
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.when(failed, "ERROR").otherwise("INFO").alias("level"),
        F.lit("ner_inference").alias("logger"),
        F.when(failed, "Inference error").otherwise("Inference completed").alias("message"),
        F.col("event_id").cast("string").alias("request_id"),
        F.lit(None).cast("string").alias("trace_id"),
        F.concat(F.lit("v"), F.pmod(user, F.lit(2)).cast("string")).alias("model_version"),
        answered(F.col("value")).alias("latency_ms"),
        answered(counts).alias("entity_counts"),
        answered(F.get_json_object("props", "$.k").cast("int") * 6).alias("input_length"),
        F.when(failed, 500).otherwise(200).alias("status_code"),
        F.when(failed, F.when(F.pmod(user, F.lit(3)) == 0, "TimeoutError").otherwise("ValueError")).alias("error_type"),
    )


def log(spark: SparkSession, sf: str) -> DataFrame:
    return as_log(t.table(spark, sf, "events"))


LOG = """log AS (
  SELECT ts, epoch_us(ts) AS us, event_id, user_id, CAST(event_id AS VARCHAR) AS request_id,
    'v' || CAST(user_id % 2 AS VARCHAR) AS model_version,
    CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS level,
    CASE WHEN event_type = 'error' THEN 'error' ELSE 'success' END AS status,
    CASE WHEN event_type <> 'error' THEN value END AS latency_ms,
    CASE WHEN event_type <> 'error' THEN user_id % 4 END AS chemical,
    CASE WHEN event_type <> 'error' THEN user_id % 3 END AS disease,
    CASE WHEN event_type <> 'error' THEN CAST(props ->> '$.k' AS INTEGER) * 6 END AS input_length,
    CASE WHEN event_type = 'error' THEN CASE user_id % 3 WHEN 0 THEN 'TimeoutError' ELSE 'ValueError' END END AS error_type
  FROM events),
entities AS (
  SELECT ts, us, model_version, 'Chemical' AS entity_type, chemical AS n FROM log WHERE chemical > 0
  UNION ALL SELECT ts, us, model_version, 'Disease', disease FROM log WHERE disease > 0)"""


def seconds(df: DataFrame, *columns: str) -> DataFrame:
    """Timestamps as seconds, so that results compare without time zones."""
    return df.withColumns({c: F.unix_seconds(c) for c in columns})


FLAT = """epoch_us(ts) AS us, level, request_id, model_version, latency_ms, input_length, error_type,
  CAST(nullif(chemical, 0) AS INTEGER) AS chemical, CAST(nullif(disease, 0) AS INTEGER) AS disease"""


def _flat(df: DataFrame) -> DataFrame:
    return df.select(
        F.unix_micros("timestamp").alias("us"),
        "level",
        "request_id",
        "model_version",
        "latency_ms",
        "input_length",
        "error_type",
        F.try_element_at("entity_counts", F.lit("Chemical")).alias("chemical"),
        F.try_element_at("entity_counts", F.lit("Disease")).alias("disease"),
    )


@query("s06_read_request_log", f"WITH {LOG} SELECT {FLAT} FROM log")
def s06(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "request-log")
    log(spark, sf).write.option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(path)
    return _flat(files.read_request_log(spark, path))


@query(
    "o01_parse_request_log",
    f"""WITH {LOG}
    SELECT CASE WHEN event_id % 7 = 0 THEN 'corrupt' ELSE level END AS kind, count(*) AS lines,
      round(sum(CASE WHEN event_id % 7 <> 0 THEN latency_ms END), 2) AS latency_ms,
      count(CASE WHEN event_id % 7 <> 0 THEN input_length END) AS with_length FROM log GROUP BY 1""",
)
def o01(spark: SparkSession, sf: str) -> DataFrame:
    """Every seventh line is cut off in the middle."""
    line = F.to_json(F.struct("*"))
    cut = F.pmod(F.col("request_id").cast("bigint"), F.lit(7)) == 0
    half = F.substr(line, F.lit(1), F.floor(F.length(line) / 2).cast("int"))
    lines = log(spark, sf).select(F.when(cut, half).otherwise(line).alias("value"))
    parsed = files.parse_request_log(lines)
    broken = F.col("corrupt").isNotNull()
    return parsed.groupBy(F.when(broken, "corrupt").otherwise(F.col("level")).alias("kind")).agg(
        F.count(F.lit(1)).alias("lines"),
        F.round(F.sum(F.when(~broken, F.col("latency_ms"))), 2).alias("latency_ms"),
        F.count(F.when(~broken, F.col("input_length"))).alias("with_length"),
    )


@query("o02_request_counts", f"WITH {LOG} SELECT model_version, status, count(*) AS requests FROM log GROUP BY ALL")
def o02(spark: SparkSession, sf: str) -> DataFrame:
    return req.request_counts(log(spark, sf))


@query(
    "o03_error_counts",
    f"WITH {LOG} SELECT model_version, error_type, count(*) AS errors FROM log WHERE error_type IS NOT NULL GROUP BY ALL",
)
def o03(spark: SparkSession, sf: str) -> DataFrame:
    return req.error_counts(log(spark, sf))


@query(
    "o04_entity_counts",
    f"WITH {LOG} SELECT model_version, entity_type, CAST(sum(n) AS BIGINT) AS entities FROM entities GROUP BY ALL",
)
def o04(spark: SparkSession, sf: str) -> DataFrame:
    return req.entity_counts(log(spark, sf))


def sql_buckets(source: str, by: str, value: str, bounds: list[float], extra: str = "") -> str:
    """Cumulative bucket rows by comparing every row with every bound."""
    values = ", ".join(f"('{b:g}', CAST({b} AS DOUBLE))" for b in bounds)
    return f"""bounds(le, b) AS (VALUES {values}, ('+Inf', CAST('Infinity' AS DOUBLE))),
bucket_rows AS (
  SELECT {by}, le, b, count(*) FILTER ({value} <= b) AS bucket, count(*) AS count, sum({value}) AS sum
  FROM {source} CROSS JOIN bounds WHERE {value} IS NOT NULL {extra} GROUP BY {by}, le, b)"""


def _histogram(df: DataFrame, value: str | Column, bounds: list[float]) -> DataFrame:
    rows = req.bucket_rows(req.buckets(df, ["model_version"], value, bounds), bounds)
    return rows.withColumn("sum", F.round(F.col("sum").cast("double"), 4))


SELECT_BUCKETS = "SELECT model_version, le, bucket, count, round(CAST(sum AS DOUBLE), 4) AS sum FROM bucket_rows"


@query(
    "o05_latency_histogram",
    f"WITH {LOG}, {sql_buckets('log', 'model_version', '(latency_ms / 1000)', req.LATENCY_BOUNDS)} {SELECT_BUCKETS}",
)
def o05(spark: SparkSession, sf: str) -> DataFrame:
    answered = log(spark, sf).filter(F.col("latency_ms").isNotNull())
    return _histogram(answered, req.latency_seconds(), req.LATENCY_BOUNDS)


@query(
    "o06_input_length_histogram",
    f"WITH {LOG}, {sql_buckets('log', 'model_version', 'input_length', req.INPUT_LENGTH_BOUNDS)} {SELECT_BUCKETS}",
)
def o06(spark: SparkSession, sf: str) -> DataFrame:
    return _histogram(log(spark, sf), "input_length", req.INPUT_LENGTH_BOUNDS)


@query(
    "o07_confidence_histogram",
    f"""WITH {tok.PIECES}, {tok.sql_labelled()}, versions AS (
      SELECT 'v' || CAST(CAST(doc_id AS BIGINT) % 2 AS VARCHAR) AS model_version, confidence FROM labelled),
    {sql_buckets('versions', 'model_version', 'confidence', req.CONFIDENCE_BOUNDS)} {SELECT_BUCKETS}""",
)
def o07(spark: SparkSession, sf: str) -> DataFrame:
    version = F.concat(F.lit("v"), F.pmod(F.col("doc_id").cast("bigint"), F.lit(2)).cast("string"))
    tokens = tok.labelled(spark, sf).select(version.alias("model_version"), F.inline("tokens"))
    return _histogram(tokens, "confidence", req.CONFIDENCE_BOUNDS)


@query(
    "o08_batch_size_histogram",
    f"""WITH {LOG}, batches AS (
      SELECT model_version, us // 3600000000 AS h, count(*) AS batch_size FROM log GROUP BY ALL),
    {sql_buckets('batches', 'model_version', 'batch_size', req.BATCH_SIZE_BOUNDS)} {SELECT_BUCKETS}""",
)
def o08(spark: SparkSession, sf: str) -> DataFrame:
    return _histogram(req.batch_sizes(log(spark, sf), "1 hour"), "batch_size", req.BATCH_SIZE_BOUNDS)


SLA = """split AS (
  SELECT model_version, count(*) FILTER (latency_ms > 50) AS violations, count(*) FILTER (latency_ms <= 50) AS within
  FROM log WHERE latency_ms IS NOT NULL GROUP BY model_version)"""


@query("o09_sla_split", f"WITH {LOG}, {SLA} SELECT * FROM split")
def o09(spark: SparkSession, sf: str) -> DataFrame:
    return req.sla_split(log(spark, sf))


@query(
    "o10_sla_compliance",
    f"""WITH {LOG}, {SLA}, shares AS (SELECT *, within * 100 / nullif(within + violations, 0) AS p FROM split)
    SELECT model_version, violations, within, round(p, 6) AS compliance_pct,
      CASE WHEN p >= 99 THEN 'green' WHEN p >= 95 THEN 'yellow' ELSE 'red' END AS band FROM shares""",
)
def o10(spark: SparkSession, sf: str) -> DataFrame:
    return req.sla_compliance(req.sla_split(log(spark, sf))).withColumn("compliance_pct", F.round("compliance_pct", 6))


def _rounded_rate(df: DataFrame) -> DataFrame:
    return seconds(df, "window_start").withColumn("rate", F.round("rate", 9))


def sql_window(span: int) -> str:
    return f"(us // {span * 1_000_000}) * {span} AS window_start"


@query(
    "o11_request_rate",
    f"""WITH {LOG} SELECT {sql_window(60)}, model_version, status, count(*) AS requests, round(count(*) / 60, 9) AS rate
    FROM log GROUP BY ALL""",
)
def o11(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded_rate(req.request_rate(log(spark, sf)))


@query(
    "o11_request_rate_sliding",
    f"""WITH {LOG}, slid AS (SELECT (us // 20000000 - k) * 20 AS window_start, model_version, status
      FROM log, range(3) r(k))
    SELECT window_start, model_version, status, count(*) AS requests, round(count(*) / 60, 9) AS rate
    FROM slid GROUP BY ALL""",
)
def o11_sliding(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded_rate(req.request_rate(log(spark, sf), slide="20 seconds"))


def sql_slid(span: int, slide: int, source: str = "log") -> str:
    """Every row once for each window of ``span`` seconds that it falls into."""
    return f"""slid AS (SELECT *, (us // {slide * 1_000_000} - k) * {slide} AS window_start
      FROM {source}, range({span // slide}) r(k))"""


@query(
    "o11_request_rate_5m_15s",
    f"""WITH {LOG}, {sql_slid(300, 15)}
    SELECT window_start, model_version, status, count(*) AS requests, round(count(*) / 300, 9) AS rate
    FROM slid GROUP BY ALL""",
)
def o11_panes(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded_rate(req.request_rate(log(spark, sf), "5 minutes", 300, "15 seconds"))


@query(
    "o13_entity_rate_5m_15s",
    f"""WITH {LOG}, {sql_slid(300, 15, "entities")}
    SELECT window_start, model_version, entity_type, CAST(sum(n) AS BIGINT) AS entities,
      round(CAST(sum(n) AS BIGINT) / 300, 9) AS rate FROM slid GROUP BY ALL""",
)
def o13_panes(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded_rate(req.entity_rate(log(spark, sf), slide="15 seconds"))


@query(
    "o14_error_rate_5m_15s",
    f"""WITH {LOG}, {sql_slid(300, 15)}
    SELECT window_start, model_version, error_type, count(*) AS errors, round(count(*) / 300, 9) AS rate
    FROM slid WHERE error_type IS NOT NULL GROUP BY ALL""",
)
def o14_panes(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded_rate(req.error_rate(log(spark, sf), slide="15 seconds"))


@query(
    "o15_bucket_rate_5m_1m",
    f"""WITH {LOG}, {sql_slid(300, 60)},
    {sql_buckets('slid', 'window_start, model_version', 'input_length', req.INPUT_LENGTH_BOUNDS)}
    SELECT window_start, model_version, le, bucket, round(bucket / 300, 9) AS rate FROM bucket_rows""",
)
def o15_panes(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded_rate(req.bucket_rate(log(spark, sf), "input_length", req.INPUT_LENGTH_BOUNDS, slide="1 minute"))


QUANTILES = f"""{LOG}, windowed AS (SELECT *, {sql_window(300)} FROM log),
{sql_buckets('windowed', 'window_start, model_version', '(latency_ms / 1000)', req.LATENCY_BOUNDS)},
stepped AS (
  SELECT *, lag(bucket, 1, 0) OVER w AS below, lag(b, 1, 0) OVER w AS low, max(bucket) OVER g AS total,
    max(CASE WHEN le <> '+Inf' THEN b END) OVER g AS highest
  FROM bucket_rows
  WINDOW w AS (PARTITION BY window_start, model_version ORDER BY b), g AS (PARTITION BY window_start, model_version)),
quantiles AS (
  SELECT window_start, model_version, max(total) AS count, q, arg_min(
    CASE WHEN le = '+Inf' THEN highest ELSE low + (b - low) * (total * q - below) / (bucket - below) END, b) AS v
  FROM stepped CROSS JOIN (VALUES (0.5), (0.95), (0.99)) qs(q)
  WHERE bucket >= total * q GROUP BY window_start, model_version, q)"""


@query(
    "o12_latency_quantiles",
    f"""WITH {QUANTILES} SELECT window_start, model_version, max(count) AS count,
      round(max(v) FILTER (q = 0.5), 9) AS p50, round(max(v) FILTER (q = 0.95), 9) AS p95,
      round(max(v) FILTER (q = 0.99), 9) AS p99 FROM quantiles GROUP BY ALL""",
)
def o12(spark: SparkSession, sf: str) -> DataFrame:
    found = seconds(req.windowed_quantiles(log(spark, sf)), "window_start")
    return found.withColumns({c: F.round(c, 9) for c in ("p50", "p95", "p99")})


@query(
    "o12_merged_sketches",
    f"""WITH {LOG}, days AS (SELECT (us // 864000000000) * 864000 AS window_start, model_version, latency_ms FROM log)
    SELECT window_start, model_version, count(*) AS count, true AS p50_near, true AS p95_near, true AS p99_near
    FROM days WHERE latency_ms IS NOT NULL GROUP BY ALL""",
)
def o12_sketches(spark: SparkSession, sf: str) -> DataFrame:
    """Sketches of every minute, stored, then merged over ten days: whether the
    rank of each quantile among the rows is within the stated error."""
    rows, span = log(spark, sf).filter(F.col("latency_ms").isNotNull()), "10 days"
    stored = via_table(sketches.latency_sketches(rows, ["model_version"]), "minute-sketches")
    keys = ["model_version"]
    found = sketches.sketch_quantiles(sketches.merged(stored, [sketches.later_window(span), *keys]))
    wide = rows.withColumn("window", F.window("timestamp", span))
    # Three times the error: the stated one holds with 99 % confidence.
    slack = 3 * sketches.rank_error()
    names = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    both = join_keys(wide.select("window", *keys, "latency_ms"), found, ["window", *keys])
    below = [F.count_if(F.col("latency_ms") < F.col(p)).alias(f"_below_{p}") for p in names]
    upto = [F.count_if(F.col("latency_ms") <= F.col(p)).alias(f"_upto_{p}") for p in names]
    ranked = both.groupBy("window", *keys, "count").agg(*below, *upto)
    near = [
        ((F.col(f"_below_{p}") <= (q + slack) * F.col("count")) & (F.col(f"_upto_{p}") >= (q - slack) * F.col("count"))).alias(f"{p}_near")
        for p, q in names.items()
    ]
    return ranked.select(F.unix_seconds("window.start").alias("window_start"), *keys, "count", *near)


@query(
    "o13_entity_rate",
    f"""WITH {LOG} SELECT {sql_window(300)}, model_version, entity_type, CAST(sum(n) AS BIGINT) AS entities,
      round(CAST(sum(n) AS BIGINT) / 300, 9) AS rate FROM entities GROUP BY ALL""",
)
def o13(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded_rate(req.entity_rate(log(spark, sf)))


@query(
    "o14_error_rate",
    f"""WITH {LOG} SELECT {sql_window(300)}, model_version, error_type, count(*) AS errors,
      round(count(*) / 300, 9) AS rate FROM log WHERE error_type IS NOT NULL GROUP BY ALL""",
)
def o14(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded_rate(req.error_rate(log(spark, sf)))


@query(
    "o15_bucket_rate",
    f"""WITH {LOG}, windowed AS (SELECT *, {sql_window(300)} FROM log),
    {sql_buckets('windowed', 'window_start, model_version', 'input_length', req.INPUT_LENGTH_BOUNDS)}
    SELECT window_start, model_version, le, bucket, round(bucket / 300, 9) AS rate FROM bucket_rows""",
)
def o15(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded_rate(req.bucket_rate(log(spark, sf), "input_length", req.INPUT_LENGTH_BOUNDS))


def load_tests(spark: SparkSession, sf: str) -> DataFrame:
    """A load test is a hundred consecutive requests."""
    return log(spark, sf).select(
        F.floor(F.col("request_id").cast("bigint") / 100).alias("test"),
        "request_id",
        F.coalesce("latency_ms", F.lit(0.0)).alias("latency_ms"),
        F.aggregate(
            F.map_values(F.coalesce("entity_counts", F.create_map().cast("map<string,int>"))), F.lit(0), lambda a, n: a + n
        ).alias("num_entities"),
        F.coalesce("input_length", F.lit(0)).alias("num_tokens"),
        req.request_status(log(spark, sf)).alias("status"),
        F.col("error_type").alias("error"),
    )


@query(
    "s08_read_load_test",
    f"""WITH {LOG} SELECT request_id, coalesce(latency_ms, 0) AS latency_ms,
      CAST(coalesce(chemical, 0) + coalesce(disease, 0) AS INTEGER) AS num_entities,
      coalesce(input_length, 0) AS num_tokens, status, error_type AS error FROM log""",
)
def s08(spark: SparkSession, sf: str) -> DataFrame:
    """Each load test is written as one file with a JSON array of its hundred results."""
    path = scratch_path(spark, "load-tests")
    results = load_tests(spark, sf)
    rows = F.struct(*[c for c in results.columns if c != "test"])
    arrays = results.groupBy("test").agg(F.to_json(F.collect_list(rows)).alias("value"))
    sinks.write_text_files(arrays, path, "test", "value")
    return files.read_load_test(spark, path)


@query(
    "o16_load_test_summary",
    f"""WITH {LOG}, results AS (SELECT *, event_id // 100 AS test FROM log),
    ranked AS (SELECT test, latency_ms, row_number() OVER (PARTITION BY test ORDER BY latency_ms) - 1 AS i,
      count(*) OVER (PARTITION BY test) AS n FROM results WHERE status = 'success'),
    p AS (SELECT test, max(latency_ms) FILTER (i = CAST(floor(n * 0.95) AS BIGINT)) AS p95_ms FROM ranked GROUP BY test)
    SELECT test, count(*) FILTER (status = 'success') AS successes, count(*) FILTER (status = 'error') AS errors,
      {t.sql_half_up('avg(latency_ms)', 6)} AS mean_ms, max(p95_ms) AS p95_ms, count(*) FILTER (latency_ms > 50) AS violations
    FROM results LEFT JOIN p USING (test) GROUP BY test""",
)
def o16(spark: SparkSession, sf: str) -> DataFrame:
    return req.load_test_summary(load_tests(spark, sf), ["test"]).withColumn("mean_ms", half_up("mean_ms", 6))


@query(
    "o17_session_metrics",
    f"""WITH {LOG}
    SELECT user_id, event_id, row_number() OVER w AS requests,
      CAST(sum(chemical + disease) OVER w AS BIGINT) AS entities,
      {t.sql_half_up('CAST(sum(CAST(latency_ms AS DECIMAL(18, 6))) OVER w AS DOUBLE) / row_number() OVER w', 6)}
        AS mean_latency_ms,
      {t.sql_half_up('CAST(sum(CASE WHEN latency_ms < 50 THEN 1 ELSE 0 END) OVER w AS BIGINT) * 100 / row_number() OVER w', 6)}
        AS sla_pct
    FROM log WHERE latency_ms IS NOT NULL
    WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id ROWS UNBOUNDED PRECEDING)""",
)
def o17(spark: SparkSession, sf: str) -> DataFrame:
    events = t.table(spark, sf, "events")
    rows = as_log(events, "event_id", "user_id")
    found = req.session_metrics(rows, "user_id", ["timestamp", "event_id"])
    return found.drop("timestamp").withColumns({c: half_up(c, 6) for c in ("mean_latency_ms", "sla_pct")})


EDGES = """edges AS (
      SELECT (us // 60000000) * 60 AS span_start, 0 AS started, 1 AS ended FROM log
      UNION ALL
      SELECT ((us - CAST(round(coalesce(latency_ms, 0) * 1000) AS BIGINT)) // 60000000) * 60, 1, 0 FROM log),
    counted AS (SELECT span_start, CAST(sum(started) AS BIGINT) AS started, CAST(sum(ended) AS BIGINT) AS ended
      FROM edges GROUP BY span_start)"""


@query(
    "o18_active_requests",
    f"""WITH {LOG}, {EDGES},
    grid AS (SELECT unnest(generate_series((SELECT min(span_start) FROM counted), (SELECT max(span_start) FROM counted), 60))
      AS span_start),
    filled AS (SELECT span_start, coalesce(started, 0) AS started, coalesce(ended, 0) AS ended
      FROM grid LEFT JOIN counted USING (span_start))
    SELECT *, CAST(sum(started - ended) OVER (ORDER BY span_start) AS BIGINT) AS in_flight FROM filled""",
)
def o18(spark: SparkSession, sf: str) -> DataFrame:
    """Every minute between the first and the last edge has a row."""
    return req.active_requests(log(spark, sf))


@query(
    "o18_active_requests_edges",
    f"""WITH {LOG}, {EDGES}
    SELECT *, CAST(sum(started - ended) OVER (ORDER BY span_start) AS BIGINT) AS in_flight FROM counted""",
)
def o18_edges(spark: SparkSession, sf: str) -> DataFrame:
    return req.active_requests(log(spark, sf), dense=False)


# Name, parent, and first and last eighth of the request's time. Stages overlap, and one outlasts its parent.
STAGES = [
    ("ner_inference", None, 0, 8),
    ("tokenization", "ner_inference", 0, 2),
    ("model_inference", "ner_inference", 1, 6),
    ("postprocessing", "ner_inference", 5, 9),
    ("attention", "model_inference", 2, 4),
    ("feed_forward", "model_inference", 3, 5),
    ("export", "postprocessing", 7, 8),
]


def request_spans(spark: SparkSession, sf: str) -> DataFrame:
    length = F.round(F.col("latency_ms") * 1000).cast("bigint")
    begin = F.unix_micros("timestamp") - length

    def eighth(n: int) -> Column:
        return begin + F.floor(length * n / 8)

    parts = [
        F.struct(
            F.lit(name).alias("name"),
            F.lit(name).alias("span_id"),
            F.lit(parent).cast("string").alias("parent_id"),
            eighth(first).alias("start_us"),
            eighth(last).alias("end_us"),
        )
        for name, parent, first, last in STAGES
    ]
    answered = log(spark, sf).filter(F.col("latency_ms").isNotNull())
    return answered.select(F.col("request_id").alias("trace_id"), F.inline(F.array(*parts)))


SQL_STAGES = ", ".join(f"('{n}', {repr(p) if p else 'NULL'}, {a}, {b})" for n, p, a, b in STAGES)


@query(
    "o19_stage_durations",
    f"""WITH {LOG}, stages(name, parent, a, b) AS (VALUES {SQL_STAGES}),
    timed AS (SELECT request_id, us, CAST(round(latency_ms * 1000) AS BIGINT) AS n FROM log WHERE latency_ms IS NOT NULL),
    spans AS (SELECT request_id, name, parent, us - n + (n * a) // 8 AS s, us - n + (n * b) // 8 AS e FROM timed CROSS JOIN stages),
    inside AS (SELECT c.request_id, c.parent, c.name, greatest(c.s, p.s) AS s, least(c.e, p.e) AS e
      FROM spans c JOIN spans p ON c.request_id = p.request_id AND c.parent = p.name),
    islands AS (SELECT *, max(e) OVER (PARTITION BY request_id, parent ORDER BY s, e, name
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached FROM inside WHERE e > s),
    covered AS (SELECT request_id, parent AS name, CAST(sum(greatest(0, e - greatest(s, coalesce(reached, s)))) AS BIGINT) AS us
      FROM islands GROUP BY ALL)
    SELECT name, count(*) AS spans, round(avg(e - s) / 1000, 6) AS mean_ms,
      round(avg(e - s - coalesce(covered.us, 0)) / 1000, 6) AS mean_self_ms
    FROM spans LEFT JOIN covered USING (request_id, name) GROUP BY name""",
)
def o19(spark: SparkSession, sf: str) -> DataFrame:
    found = stage_durations(request_spans(spark, sf))
    return found.withColumns({c: F.round(c, 6) for c in ("mean_ms", "mean_self_ms")})


@query(
    "o20_freshness",
    f"""WITH {LOG} SELECT model_version, epoch_us(max(ts)) // 1000000 AS last_seen, count(*) AS events,
      CASE WHEN epoch_us(max(ts)) // 1000000 >= (SELECT epoch_us(max(ts)) // 1000000 FROM events) - 300
        THEN 'healthy' ELSE 'not_ready' END AS status FROM log GROUP BY model_version""",
)
def o20(spark: SparkSession, sf: str) -> DataFrame:
    rows = log(spark, sf)
    newest = rows.agg(F.max("timestamp")).scalar()
    return seconds(req.freshness(rows, as_of=newest, max_age_seconds=300), "last_seen")


def stream_log(spark: SparkSession, sf: str) -> DataFrame:
    """The events file as a stream of log rows."""
    schema = t.table(spark, sf, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    return as_log(events, "user_id")


def _streamed(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    path = scratch_path(spark, name)
    started = live.write_table(stream, path, scratch_path(spark, f"{name}-state"))
    started.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


CLOSED = "(SELECT max(us) - 600000000 FROM log)"


@query(
    "o21_late_data",
    f"""WITH {LOG}, rates AS (
      SELECT {sql_window(60)}, model_version, status, count(*) AS requests, round(count(*) / 60, 9) AS rate
      FROM log GROUP BY ALL)
    SELECT * FROM rates WHERE (window_start + 60) * 1000000 <= {CLOSED}""",
)
def o21(spark: SparkSession, sf: str) -> DataFrame:
    """The stream gives what batch gives for all windows the watermark has closed."""
    rates = req.request_rate(live.watermarked(stream_log(spark, sf)))
    return _rounded_rate(_streamed(spark, rates, "late-data"))


@query(
    "o12_latency_quantiles_stream",
    f"""WITH {QUANTILES} SELECT window_start, model_version, max(count) AS count,
      round(max(v) FILTER (q = 0.5), 9) AS p50, round(max(v) FILTER (q = 0.95), 9) AS p95,
      round(max(v) FILTER (q = 0.99), 9) AS p99 FROM quantiles
    WHERE (window_start + 300) * 1000000 <= {CLOSED} GROUP BY ALL""",
)
def o12_stream(spark: SparkSession, sf: str) -> DataFrame:
    found = req.windowed_quantiles(live.watermarked(stream_log(spark, sf)))
    done = seconds(_streamed(spark, found, "quantiles"), "window_start")
    return done.withColumns({c: F.round(c, 9) for c in ("p50", "p95", "p99")})


@query(
    "o17_session_totals_stream",
    f"""WITH {LOG}, answered AS (
      SELECT *, us - lag(us) OVER (PARTITION BY user_id ORDER BY us) >= 3600000000 AS starts
      FROM log WHERE latency_ms IS NOT NULL),
    numbered AS (SELECT *, sum(CASE WHEN starts THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY us) AS s
                 FROM answered),
    sessions AS (
      SELECT user_id, min(us) AS start_us, max(us) + 3600000000 AS end_us, count(*) AS requests,
        CAST(sum(chemical + disease) AS BIGINT) AS entities,
        {t.sql_half_up('avg(latency_ms)', 6)} AS mean_latency_ms,
        {t.sql_half_up('100 * avg(CASE WHEN latency_ms < 50 THEN 1.0 ELSE 0.0 END)', 6)} AS sla_pct
      FROM numbered GROUP BY user_id, s)
    SELECT * FROM sessions WHERE end_us <= (SELECT max(us) - 600000000 FROM answered)""",
)
def o17_stream(spark: SparkSession, sf: str) -> DataFrame:
    stream = stream_log(spark, sf)
    done = _streamed(spark, live.session_totals(stream, "user_id", gap="1 hour"), "sessions")
    return done.select(
        "user_id",
        F.unix_micros("session_start").alias("start_us"),
        F.unix_micros("session_end").alias("end_us"),
        "requests",
        "entities",
        half_up("mean_latency_ms", 6).alias("mean_latency_ms"),
        half_up("sla_pct", 6).alias("sla_pct"),
    )


FILES = 6
#: Every fortieth event is written two files later than its time says.
ARRIVED = f"""bounds AS (SELECT min(us) AS low, max(us) AS high FROM log),
arrived AS (SELECT log.*, least({FILES - 1}, {FILES} * (us - low) // (high - low + 1)
  + CASE WHEN event_id % 40 = 0 THEN 2 ELSE 0 END) AS file FROM log, bounds)"""


def arriving_log(spark: SparkSession, sf: str) -> DataFrame:
    """The log as a stream of ``FILES`` files, one to a micro-batch, with late rows."""
    events = t.table(spark, sf, "events")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    low, high = events.agg(F.min(us), F.max(us)).first()
    if low is None:
        low, high = 0, 0
    file = F.least(
        F.lit(FILES - 1),
        F.floor(FILES * (us - low) / (high - low + 1)) + F.when(F.col("event_id") % 40 == 0, 2).otherwise(0),
    )
    rows, path = as_log(events.withColumn("file", file), "user_id", "file"), scratch_path(spark, "arriving")
    # All tasks sort the rows into folders; a file is then written from its own folder alone.
    sorted_path = scratch_path(spark, "arriving-by-file")
    rows.write.partitionBy("file").parquet(sorted_path)
    by_file = spark.read.schema(rows.schema).parquet(sorted_path).select(*rows.columns)
    for i in range(FILES):
        by_file.filter(F.col("file") == i).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)


SESSION_GAP, LATE_DAYS = 6 * 3600, 11


@query(
    "o17_session_numbers_stream",
    f"""WITH {LOG}, answered AS (
      SELECT *, us - lag(us) OVER (PARTITION BY user_id ORDER BY us, event_id) > {SESSION_GAP * 1_000_000} AS starts
      FROM log WHERE latency_ms IS NOT NULL),
    parts AS (SELECT *, sum(CASE WHEN starts THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY us, event_id) AS part
      FROM answered),
    numbered AS (SELECT user_id, request_id, us AS at_us, row_number() OVER w AS requests,
      CAST(sum(chemical + disease) OVER w AS BIGINT) AS entities,
      {t.sql_half_up('CAST(sum(CAST(latency_ms AS DECIMAL(18, 6))) OVER w AS DOUBLE) / row_number() OVER w', 6)}
        AS mean_latency_ms,
      {t.sql_half_up('CAST(sum(CASE WHEN latency_ms < 50 THEN 1 ELSE 0 END) OVER w AS BIGINT) * 100 / row_number() OVER w', 6)}
        AS sla_pct
    FROM parts WINDOW w AS (PARTITION BY user_id, part ORDER BY us, event_id ROWS UNBOUNDED PRECEDING))
    SELECT * FROM numbered
    WHERE at_us <= (SELECT max(us) // 1000 * 1000 - {LATE_DAYS * 86_400_000_000} FROM answered)""",
)
def o17_numbers_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers of all requests the watermark has passed; late rows are counted in their place."""
    stream = arriving_log(spark, sf)
    with rocksdb_state(spark):
        done = _streamed(spark, ordered_session_numbers(stream, "user_id", SESSION_GAP, f"{LATE_DAYS} days"), "session-numbers")
    return done.withColumns({c: half_up(c, 6) for c in ("mean_latency_ms", "sla_pct")})


@query(
    "o17_session_metrics_gap",
    f"""WITH {LOG}, answered AS (
      SELECT *, us - lag(us) OVER (PARTITION BY user_id ORDER BY us, event_id) > {SESSION_GAP * 1_000_000} AS starts
      FROM log WHERE latency_ms IS NOT NULL),
    parts AS (SELECT *, sum(CASE WHEN starts THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY us, event_id) AS part
      FROM answered)
    SELECT user_id, event_id, row_number() OVER w AS requests, CAST(sum(chemical + disease) OVER w AS BIGINT) AS entities
    FROM parts WINDOW w AS (PARTITION BY user_id, part ORDER BY us, event_id ROWS UNBOUNDED PRECEDING)""",
)
def o17_gap(spark: SparkSession, sf: str) -> DataFrame:
    rows = as_log(t.table(spark, sf, "events"), "event_id", "user_id")
    found = req.session_metrics(rows, "user_id", ["timestamp", "event_id"], gap_seconds=SESSION_GAP)
    return found.select("user_id", "event_id", "requests", "entities")


@query(
    "o18_active_requests_stream",
    f"""WITH {LOG}, edges AS (
      SELECT model_version, us AS edge_us, 0 AS started, 1 AS ended FROM log
      UNION ALL
      SELECT model_version, us - CAST(round(coalesce(latency_ms, 0) * 1000) AS BIGINT), 1, 0 FROM log),
    minutes AS (SELECT model_version, (edge_us // 60000000) * 60 AS span_start, CAST(sum(started) AS BIGINT) AS started,
      CAST(sum(ended) AS BIGINT) AS ended FROM edges GROUP BY 1, 2),
    counted AS (SELECT * FROM minutes
      WHERE (span_start + 60) * 1000000 <= (SELECT max(edge_us) // 1000 * 1000 - 600000000 FROM edges)),
    grid AS (SELECT model_version, unnest(generate_series(min(span_start), max(span_start), 60)) AS span_start
      FROM counted GROUP BY model_version),
    filled AS (SELECT model_version, span_start, coalesce(started, 0) AS started, coalesce(ended, 0) AS ended
      FROM grid LEFT JOIN counted USING (model_version, span_start))
    SELECT *, CAST(sum(started - ended) OVER (PARTITION BY model_version ORDER BY span_start) AS BIGINT) AS in_flight
    FROM filled""",
)
def o18_stream(spark: SparkSession, sf: str) -> DataFrame:
    with rocksdb_state(spark):
        return _streamed(spark, active_requests_stream(stream_log(spark, sf), "model_version"), "gauge")


@query(
    "o21_late_accounting",
    f"""WITH {LOG}, {ARRIVED},
    windowed AS (SELECT *, {sql_window(60)} FROM arrived),
    newest AS (SELECT file, max(us) AS us FROM arrived GROUP BY file),
    marks AS (SELECT f.file, max(n.us) // 1000 * 1000 - 600000000 AS mark
      FROM (SELECT DISTINCT file FROM arrived) f JOIN newest n ON n.file < f.file - 1 GROUP BY f.file),
    judged AS (SELECT w.*, coalesce((window_start + 60) * 1000000 <= mark, false) AS late
      FROM windowed w LEFT JOIN marks USING (file)),
    counts AS (SELECT window_start, model_version, status, count(*) AS requests,
      count(*) FILTER (NOT late) AS streamed, count(*) FILTER (late) AS late FROM judged GROUP BY ALL)
    SELECT * FROM counts WHERE (window_start + 60) * 1000000 <= (SELECT max(us) // 1000 * 1000 - 600000000 FROM log)""",
)
def o21_accounting(spark: SparkSession, sf: str) -> DataFrame:
    """Closed windows: requests in all, those the stream counted, and those that came too late."""
    stream, keys = arriving_log(spark, sf), ["model_version", "status"]
    counted = _streamed(spark, req.request_counts(live.watermarked(stream), [F.window("timestamp", "1 minute")]), "closed")
    path = scratch_path(spark, "late")
    marked = stream.withColumn("status", req.request_status(stream))
    write_late_counts(marked, keys, "1 minute", live.WATERMARK, path, scratch_path(spark, "late-state")).awaitTermination()
    every = req.request_counts(log(spark, sf), [F.window("timestamp", "1 minute")])
    found = accounted(every, counted, late_counts(spark, path, keys), keys, "requests")
    newest = log(spark, sf).agg(F.max(F.unix_micros("timestamp"))).scalar()
    closed = F.unix_micros("window.end") <= F.floor(newest / 1000) * 1000 - 600_000_000
    return found.filter(closed).select(
        F.unix_seconds("window.start").alias("window_start"), *keys, F.col("all").alias("requests"), "streamed", "late"
    )


def _with_retries(log_rows: DataFrame) -> DataFrame:
    """Every failed request is logged again half a minute later."""
    again = log_rows.filter(F.col("level") == "ERROR")
    later = again.withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 30 SECONDS"))
    return log_rows.unionByName(later)


@query("o22_first_per_request", f"WITH {LOG} SELECT {FLAT} FROM log")
def o22(spark: SparkSession, sf: str) -> DataFrame:
    return _flat(req.first_per_request(_with_retries(log(spark, sf))))


@query("o22_first_per_request_stream", f"WITH {LOG} SELECT request_id, level FROM log")
def o22_stream(spark: SparkSession, sf: str) -> DataFrame:
    unique = live.first_per_request(_with_retries(stream_log(spark, sf)))
    return _streamed(spark, unique.select("request_id", "level"), "unique")
