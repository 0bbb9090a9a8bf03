import json
import random
from datetime import datetime, timedelta, timezone

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from corpuslab.operators import requests as req
from corpuslab.sources import files
from corpuslab.streaming import requests as live

START = datetime(2024, 1, 1, 12, 0, 0, tzinfo=timezone.utc)


def entry(i, at, latency=None, version="v1", error=None, entities=None, length=None, request=None):
    row = {
        "timestamp": (START + timedelta(seconds=at)).isoformat(),
        "level": "ERROR" if error else "INFO",
        "logger": "ner_inference",
        "message": "x",
        "request_id": request or f"r{i}",
        "model_version": version,
    }
    optional = {"latency_ms": latency, "error_type": error, "entity_counts": entities, "input_length": length}
    return {**row, **{k: v for k, v in optional.items() if v is not None}}


def entries(n=300, seed=3):
    rng, out = random.Random(seed), []
    for i in range(n):
        at = i * 3 + rng.random()
        if rng.random() < 0.2:
            out.append(entry(i, at, version=rng.choice(["v1", "v2"]), error=rng.choice(["ValueError", "KeyError"])))
        else:
            out.append(
                entry(i, at, round(rng.expovariate(0.03), 2), rng.choice(["v1", "v2"]), None,
                      {"Chemical": rng.randint(1, 4)}, rng.randint(1, 600))
            )
    return out


def write(folder, name, rows):
    folder.mkdir(exist_ok=True, parents=True)
    (folder / name).write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows) + "\n")


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("log")
    write(folder, "a.json", entries())
    return files.read_request_log(spark, str(folder))


def test_counters(log):
    rows = entries()
    counts = {(r.model_version, r.status): r.requests for r in req.request_counts(log).collect()}
    for version in ("v1", "v2"):
        mine = [r for r in rows if r["model_version"] == version]
        assert counts[version, "error"] == sum("error_type" in r for r in mine)
        assert counts[version, "success"] == sum("latency_ms" in r for r in mine)
    errors = req.error_counts(log).agg(F.sum("errors")).first()[0]
    assert errors == sum("error_type" in r for r in rows)
    found = req.entity_counts(log).agg(F.sum("entities")).first()[0]
    assert found == sum(r.get("entity_counts", {}).get("Chemical", 0) for r in rows)
    report = {r.model_version: r for r in req.sla_report(log).collect()}
    assert report["v1"].errors == counts["v1", "error"]


def quantile(latencies, bounds, q):
    counts = [sum(x <= b for x in latencies) for b in bounds] + [len(latencies)]
    rank = q * counts[-1]
    for i, n in enumerate(counts):
        if n >= rank:
            if i == len(bounds):
                return bounds[-1]
            low, below = (bounds[i - 1], counts[i - 1]) if i else (0.0, 0)
            return low + (bounds[i] - low) * (rank - below) / (n - below) if n > below else None
    return None


@settings(max_examples=10, deadline=None)
@given(st.lists(st.lists(st.sampled_from([1.0, 5.0, 5.1, 49.9, 50.0, 700.0, 2500.0, 9000.0]), min_size=1, max_size=30), min_size=1, max_size=8))
def test_bucket_quantiles(spark, groups):
    df = spark.createDataFrame([(g, x) for g, xs in enumerate(groups) for x in xs], "g int, latency_ms double")
    got = {r.g: r for r in req.latency_quantiles(df, ["g"]).collect()}
    for g, xs in enumerate(groups):
        seconds = [x / 1000 for x in xs]
        for name, q in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99)):
            assert got[g][name] == pytest.approx(quantile(seconds, req.LATENCY_BOUNDS, q))


def test_histogram_rows(spark):
    df = spark.createDataFrame([("v", x) for x in (1, 16, 17, 512, 513, None)], "m string, n int")
    counted = req.buckets(df, ["m"], "n", req.INPUT_LENGTH_BOUNDS)
    rows = [(r.le, r.bucket) for r in req.bucket_rows(counted, req.INPUT_LENGTH_BOUNDS).collect()]
    assert rows == [("16", 2), ("32", 3), ("64", 3), ("128", 3), ("256", 3), ("512", 4), ("+Inf", 5)]
    assert counted.first()["sum"] == 1059
    none = req.buckets(df.filter("n is null"), ["m"], "n", req.INPUT_LENGTH_BOUNDS)
    assert none.select(req.bucket_quantile(F.col("cumulative"), req.INPUT_LENGTH_BOUNDS, 0.5)).first()[0] is None


def test_service_level_at_the_limit(spark):
    df = spark.createDataFrame([("v", x) for x in [50.0] * 95 + [50.01] * 5] + [("w", None)], "model_version string, latency_ms double")
    split = req.sla_compliance(req.sla_split(df)).collect()
    assert [(r.within, r.violations, r.compliance_pct, r.band) for r in split] == [(95, 5, 95.0, "yellow")]
    edges = spark.createDataFrame([(99, 1), (949, 51), (0, 0)], "within long, violations long")
    assert [r.band for r in req.sla_compliance(edges).collect()] == ["green", "red", None]


def test_rates_over_windows(log):
    rows = req.request_rate(log).collect()
    assert sum(r.requests for r in rows) == 300 and all(r.rate == r.requests / 60 for r in rows)
    sliding = req.request_rate(log, "1 minute", 60, "20 seconds")
    assert sliding.agg(F.sum("requests")).first()[0] == 900
    assert req.bucket_rate(log, "input_length", req.INPUT_LENGTH_BOUNDS).filter("le = '+Inf'").agg(F.sum("bucket")).first()[0] == sum(
        "input_length" in r for r in entries()
    )


def test_malformed_lines(spark):
    lines = [json.dumps(entry(1, 0, 5.0)), '{"timestamp": "2024-01-01T', "not json", json.dumps({"level": "INFO"})]
    got = files.parse_request_log(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert [r.corrupt is not None for r in got] == [False, True, True, False]
    assert got[0].latency_ms == 5.0 and got[3].level == "INFO" and got[3].request_id is None


@pytest.mark.parametrize("group_rows", [30, 100_000])
def test_session_metrics(log, group_rows):
    rows = [r for r in entries() if "latency_ms" in r]
    got = req.session_metrics(log, "model_version", ["timestamp", "request_id"], group_rows=group_rows)
    found = {(r.model_version, r.requests): r for r in got.collect()}
    for version in ("v1", "v2"):
        mine = [r for r in rows if r["model_version"] == version]
        for n in range(1, len(mine) + 1):
            row, past = found[version, n], mine[:n]
            assert row.mean_latency_ms == pytest.approx(sum(r["latency_ms"] for r in past) / n)
            assert row.sla_pct == pytest.approx(sum(r["latency_ms"] < 50 for r in past) * 100 / n)
            assert row.entities == sum(r["entity_counts"]["Chemical"] for r in past)


@pytest.mark.parametrize("group_rows", [5, 100_000])
def test_active_requests(spark, group_rows):
    # (end second, duration in ms)
    rows = [(61.0, 2000.0), (70.0, 1000.0), (125.0, 70_000.0), (130.0, 0.5), (400.0, 300_000.0)]
    df = spark.createDataFrame(
        [(START + timedelta(seconds=e), d) for e, d in rows], "timestamp timestamp, latency_ms double"
    )
    base = int(START.timestamp())
    for dense in (False, True):
        found = req.active_requests(df, group_rows=group_rows, dense=dense).collect()
        got = {r.span_start - base: (r.started, r.ended, r.in_flight) for r in found}
        steps = {180: (0, 0, 1), 240: (0, 0, 1), 300: (0, 0, 1)} if dense else {}
        assert got == {0: (2, 0, 2), 60: (2, 2, 2), 120: (1, 2, 1), 360: (0, 1, 0), **steps} and len(found) == len(got)
    assert req.active_requests(df.limit(0)).count() == 0


def test_freshness_and_load_test(spark, log):
    now = F.lit(START + timedelta(seconds=900)).cast("timestamp")
    assert {r.status for r in req.freshness(log).collect()} == {"healthy"}
    assert {r.status for r in req.freshness(log, now, 100_000).collect()} == {"healthy"}
    late = F.lit(START + timedelta(days=9)).cast("timestamp")
    assert {r.status for r in req.freshness(log, late, 60).collect()} == {"not_ready"}
    results = spark.createDataFrame(
        [("t", "success", float(i)) for i in range(1, 101)] + [("t", "error", 0.0), ("bad", "error", 0.0)],
        "test string, status string, latency_ms double",
    )
    summary = {r.test: r for r in req.load_test_summary(results, ["test"]).collect()}
    assert (summary["t"].successes, summary["t"].errors, summary["t"].p95_ms, summary["t"].violations) == (100, 1, 96.0, 50)
    assert summary["bad"].p95_ms is None


# ---- streams


def run(spark, stream, tmp_path, name):
    live.write_table(stream, f"{tmp_path}/{name}", f"{tmp_path}/{name}-state").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{tmp_path}/{name}")


def test_stream_equals_batch_and_drops_late_rows(spark, tmp_path):
    rows = entries(400)
    half = [r for r in rows if r["timestamp"] < (START + timedelta(seconds=900)).isoformat()]
    source = tmp_path / "in"
    write(source, "1.json", half[:150])
    write(source, "2.json", half[150:])
    log = files.read_request_log(spark, str(source), streaming=True)
    rates = req.request_rate(live.watermarked(log, "2 minutes"))
    run(spark, rates, tmp_path, "rates")
    late = entry(9999, 5, 1.0, version="late")
    write(source, "3.json", [late] + [r for r in rows if r not in half])
    got = run(spark, rates, tmp_path, "rates")
    batch = req.request_rate(files.read_request_log(spark, str(source)).filter("model_version <> 'late'"))
    newest = batch.agg(F.max("window_start")).first()[0]
    closed = batch.filter(F.col("window_start") < F.lit(newest - timedelta(minutes=3)))
    assert got.filter("model_version = 'late'").count() == 0
    assert closed.exceptAll(got).count() == 0 and got.exceptAll(batch).count() == 0 and closed.count() > 20


def test_windowed_panels_on_a_stream(spark, tmp_path):
    write(tmp_path / "in", "1.json", entries(400))
    log = live.watermarked(files.read_request_log(spark, str(tmp_path / "in"), streaming=True))
    for name, panel in (("q", req.windowed_quantiles), ("e", req.entity_rate), ("x", req.error_rate)):
        got = run(spark, panel(log), tmp_path, name)
        batch = panel(files.read_request_log(spark, str(tmp_path / "in")))
        assert got.count() > 0 and got.exceptAll(batch).count() == 0


def test_repeats_in_batch_and_stream(spark, tmp_path):
    rows = entries(60) + [entry(0, 30, 1.0, request=f"r{i}") for i in range(0, 60, 4)]
    write(tmp_path / "in", "1.json", rows)
    batch = req.first_per_request(files.read_request_log(spark, str(tmp_path / "in")))
    assert batch.count() == 60
    want = {}
    for r in rows:
        if r["request_id"] not in want or r["timestamp"] < want[r["request_id"]]:
            want[r["request_id"]] = r["timestamp"]
    got = {r.request_id: r.us for r in batch.select("request_id", F.unix_micros("timestamp").alias("us")).collect()}
    micros = {k: (datetime.fromisoformat(v) - START) // timedelta(microseconds=1) for k, v in want.items()}
    assert got == {k: v + int(START.timestamp()) * 1_000_000 for k, v in micros.items()}
    stream = live.first_per_request(files.read_request_log(spark, str(tmp_path / "in"), streaming=True))
    assert run(spark, stream.select("request_id"), tmp_path, "unique").count() == 60


def test_sessions_end_after_a_gap(spark, tmp_path):
    rows = [entry(i, at, 10.0, entities={"Disease": 1}) for i, at in enumerate([0, 60, 120, 4000, 4030, 20_000])]
    write(tmp_path / "in", "1.json", rows)
    stream = live.session_totals(files.read_request_log(spark, str(tmp_path / "in"), streaming=True), "model_version", "5 minutes")
    got = sorted((r.requests, r.entities, r.sla_pct) for r in run(spark, stream, tmp_path, "s").collect())
    assert got == [(2, 2, 100.0), (3, 3, 100.0)]


def test_running_numbers_on_a_stream(spark, tmp_path):
    rows = entries(300)
    source = tmp_path / "in"
    for i in range(3):
        write(source, f"{i}.json", rows[i * 100 : (i + 1) * 100])
        log = files.read_request_log(spark, str(source), streaming=True)
        got = run(spark, live.session_numbers(log, "model_version"), tmp_path, "numbers")
    batch = req.session_metrics(files.read_request_log(spark, str(source)), "model_version", ["timestamp"])
    names = ["model_version", "timestamp", "requests", "entities"]
    assert sorted(map(tuple, got.select(names).collect())) == sorted(map(tuple, batch.select(names).collect()))
    both = got.join(batch.withColumnsRenamed({"mean_latency_ms": "m", "sla_pct": "s"}), ["model_version", "timestamp"])
    assert both.filter("abs(mean_latency_ms - m) > 1e-9 or abs(sla_pct - s) > 1e-9").count() == 0


def test_running_numbers_begin_again_after_a_gap(spark, tmp_path):
    source = tmp_path / "in"
    for i, at in enumerate([0, 60, 20_000, 40_000]):
        write(source, f"{i}.json", [entry(i, at, 10.0, entities={"Disease": 1}), entry(50 + i, at + 1, 90.0)])
        log = files.read_request_log(spark, str(source), streaming=True)
        got = run(spark, live.session_numbers(log, "model_version", 300, "1 minute"), tmp_path, "again")
    found = [(r.requests, r.entities, r.sla_pct) for r in got.orderBy("timestamp").collect()]
    once = [(1, 1, 100.0), (2, 1, 50.0)]
    assert found == [*once, (3, 2, 200 / 3), (4, 2, 50.0), *once, *once]


def test_load_tests_stand_in_few_folders(spark, tmp_path):
    from pathlib import Path

    from corpuslab.catalog import requests as queries
    from corpuslab.session import scratch_tables, shared_folder

    start = datetime(2024, 1, 1)
    kinds = ("click", "error", "view")
    rows = [(i, start + timedelta(seconds=i), i % 9, kinds[i % 3], float(i % 90), "{}") for i in range(30_000)]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "events.parquet"))
    want = sorted(tuple(r) for r in queries.load_tests(spark, str(tmp_path)).drop("test").collect())
    before = set(Path(shared_folder(spark)).glob("load-tests-*"))
    with scratch_tables():
        got = sorted(tuple(r) for r in queries.s08(spark, str(tmp_path)).collect())
        written = set(Path(shared_folder(spark)).glob("load-tests-*")) - before
        folders = [p for w in written for p in w.rglob("*") if p.is_dir()]
    assert [r[0] for r in got] == [r[0] for r in want] and [r[1:5] for r in got] == [r[1:5] for r in want]
    assert len(folders) < 50
