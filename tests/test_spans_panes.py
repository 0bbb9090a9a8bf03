"""Union of child intervals, dense grids, and sliding windows by panes."""

import random
from collections import Counter
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from corpuslab.operators import requests as req
from corpuslab.operators.panes import micros, pane_of, sliding
from corpuslab.operators.scan import Running, running
from corpuslab.operators.spans import covered_time, on_grid, stage_durations

SPAN = "trace_id string, span_id string, parent_id string, name string, start_us long, end_us long"


def random_spans(seed, traces=20, children=12):
    """Nested and parallel spans; children may begin before and end after their parent."""
    rng = random.Random(seed)
    rows = []
    for t in range(traces):
        held = [("root", None, 0, 1_000)]
        for i in range(rng.randrange(children)):
            parent = rng.choice(held)
            a = rng.randrange(parent[2] - 50, parent[3] + 50)
            held.append((f"s{i}", parent[0], a, a + rng.choice([0, 1, 5, 100, 400, 2_000])))
        rows += [(f"t{t}", s, p, f"n{len(s)}{s[-1]}", a, b) for s, p, a, b in held]
    return rows


def plain_covered(rows):
    out = {}
    for t, s, _, _, a, b in rows:
        points = set()
        for u, _, p, _, c, d in rows:
            if u == t and p == s:
                points |= set(range(max(a, c), min(b, d)))
        if points:
            out[t, s] = len(points)
    return out


@pytest.mark.parametrize("group_rows", [3, 1_000_000])
@pytest.mark.parametrize("seed", range(3))
def test_covered_time_against_points(spark, seed, group_rows):
    rows = random_spans(seed)
    df = spark.createDataFrame(rows, SPAN).repartition(3)
    got = {(r.trace_id, r.span_id): r.covered_us for r in covered_time(df, group_rows).collect()}
    assert got == plain_covered(rows)


def test_parallel_children_and_one_hot_parent(spark):
    two = [("t", "a", None, "request", 0, 100_000), ("t", "b", "a", "x", 0, 80_000), ("t", "c", "a", "x", 10_000, 90_000)]
    got = {r.name: (r.spans, r.mean_ms, r.mean_self_ms) for r in stage_durations(spark.createDataFrame(two, SPAN)).collect()}
    assert got == {"request": (1, 100.0, 10.0), "x": (2, 80.0, 80.0)}
    hot = [("h", "root", None, "request", 0, 50_000)] + [("h", f"k{i}", "root", "kid", 5 * i, 5 * i + 3 + i % 4) for i in range(9_000)]
    self_time = stage_durations(spark.createDataFrame(hot, SPAN), group_rows=500).filter("name = 'request'").first().mean_self_ms
    assert self_time == (50_000 - plain_covered(hot)["h", "root"]) / 1000
    lost = [("t", "a", "gone", "x", 0, 5), (None, "a", None, "x", 0, 5), ("t", "b", None, "y", 3, 3)]
    assert {r.name: r.mean_self_ms for r in stage_durations(spark.createDataFrame(lost, SPAN)).collect()} == {"x": 0.005, "y": 0.0}
    assert stage_durations(spark.createDataFrame([], SPAN)).count() == 0


@pytest.mark.parametrize("group_rows", [4, 1_000])
def test_maximum_before(spark, group_rows):
    rng = random.Random(1)
    rows = [(g, i, rng.choice([None, rng.randrange(50)])) for g in ("a", "b", None) for i in range(40)]
    df = spark.createDataFrame(rows, "g string, i long, v int").repartition(3)
    got = {(r.g, r.i): r.m for r in running(df, ["g"], ["i"], [Running("m", "max_before", F.col("v"))], group_rows).collect()}
    for g, i, _ in rows:
        assert got[g, i] == max((v for h, j, v in rows if h == g and j < i and v is not None), default=None)


def test_grid_over_long_gaps(spark):
    df = spark.createDataFrame([(0, 3, 3), (10, 1, 4), (500_010, 0, 2)], "at long, n int, level long")
    got = on_grid(df, "at", "level", ["n"], 10)
    assert got.count() == 50_002
    assert got.agg(F.sum("n"), F.sum("level")).first()[:] == (4, 3 + 4 * 50_000 + 2)
    assert got.select(F.count_distinct("at"), F.min("at"), F.max("at")).first()[:] == (50_002, 0, 500_010)


START = datetime(2024, 1, 1, tzinfo=timezone.utc)


@pytest.mark.parametrize(("span", "slide"), [("60 seconds", "20 seconds"), ("5 minutes", "15 seconds"), ("50 seconds", "20 seconds"), ("1 minute", "1 minute")])
@pytest.mark.parametrize("group_rows", [10, 1_000_000])
def test_panes_are_windows(spark, span, slide, group_rows):
    rng = random.Random(5)
    at = [rng.choice([rng.uniform(0, 400), rng.uniform(5_000, 5_200), rng.uniform(90_000, 90_010)]) for _ in range(400)]
    rows = [(START + timedelta(seconds=round(s, 3)), rng.choice(["a", "b", None]), rng.randrange(3)) for s in at]
    df = spark.createDataFrame(rows, "timestamp timestamp, k string, n int")
    counted = df.groupBy(pane_of("timestamp", span, slide), "k").agg(F.sum("n").alias("n"), F.count("*").alias("rows"))
    got = sliding(counted, ["k"], ["n", "rows"], span, slide, group_rows)
    want = df.groupBy(F.window("timestamp", span, slide), "k").agg(F.sum("n").alias("n"), F.count("*").alias("rows"))
    flat = ["window.start", "window.end", "k", "n", "rows"]
    assert Counter(map(tuple, got.select(*flat).collect())) == Counter(map(tuple, want.select(*flat).collect()))


def test_no_event_is_copied(spark):
    df = spark.range(1_000).selectExpr(
        "timestamp_seconds(id * 7) AS timestamp", "'v' AS model_version", "CAST(null AS string) AS error_type", "'INFO' AS level"
    )
    rate = req.request_rate(df, "5 minutes", 300, "15 seconds")
    plan = rate._jdf.queryExecution().optimizedPlan().toString()
    # Copies are made of panes, above the first aggregate.
    assert "Expand" not in plan and plan.count("Range (0, 1000") >= 1
    assert rate.agg(F.sum("requests")).first()[0] == 1_000 * 20
    with pytest.raises(ValueError):
        req.request_rate(df, "1 minute", 60, "2 minutes")
    assert micros("15 seconds") == 15_000_000 and micros("1 hour") == 3_600_000_000


def test_panes_on_a_stream(spark, tmp_path):
    from corpuslab.streaming import requests as live

    rows = [(START + timedelta(seconds=i * 2.5), ["v1", "v2"][i % 2], None, "INFO", float(i % 90)) for i in range(2_000)]
    schema = "timestamp timestamp, model_version string, error_type string, level string, latency_ms double"
    df = spark.createDataFrame(rows, schema)
    for i in range(3):  # three files
        part = df.filter(F.pmod(F.unix_seconds("timestamp"), F.lit(3)) == i)
        part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = live.watermarked(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), "1 minute")
    panels = {
        "rate": lambda log: req.request_rate(log, "1 minute", 60, "15 seconds"),
        "quantiles": lambda log: req.windowed_quantiles(log, "1 minute", "15 seconds"),
    }
    for name, panel in panels.items():
        live.write_table(panel(stream), f"{tmp_path}/{name}", f"{tmp_path}/{name}-state").awaitTermination()
        got = spark.read.parquet(f"{tmp_path}/{name}")
        batch = panel(df)
        ended = batch.filter(F.unix_seconds("window_start") + 60 <= int(START.timestamp()) + 1_999 * 2.5 - 60 - 60)
        assert got.exceptAll(batch).count() == 0 and ended.exceptAll(got).count() == 0 and ended.count() > 500
