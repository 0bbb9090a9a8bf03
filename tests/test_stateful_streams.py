"""Arbitrary state with timers, the dense gauge, and accounting of late rows."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from corpuslab.operators import requests as req
from corpuslab.streaming import requests as live
from corpuslab.streaming.late import accounted, late_counts, write_late_counts
from corpuslab.streaming.stateful import PROVIDER, active_requests_stream, ordered_session_numbers, rocksdb_state

START = datetime(2024, 1, 1, 12, tzinfo=timezone.utc)
LOG = "user_id long, timestamp timestamp, request_id string, model_version string, level string, error_type string, latency_ms double, entity_counts map<string,int>"


def requests(n, seed, step=20.0, users=4):
    rng = random.Random(seed)
    return [
        (
            rng.choice([None, *range(users)]),
            START + timedelta(seconds=round(i * step + rng.random() * step + (5_000 if i > n // 2 else 0), 3)),
            f"r{i}",
            f"v{rng.randrange(2)}",
            "INFO",
            None,
            round(rng.expovariate(0.02), 2),
            rng.choice([None, {"Disease": rng.randrange(3)}]),
        )
        for i in range(n)
    ]


def in_files(spark, folder, parts):
    """Parquet files, one to a micro-batch, and the stream over them."""
    for rows in parts:
        spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(spark.createDataFrame([], LOG).schema).option("maxFilesPerTrigger", 1).parquet(folder)


def run(spark, stream, tmp_path, name):
    with rocksdb_state(spark):
        live.write_table(stream, f"{tmp_path}/{name}", f"{tmp_path}/{name}-state").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{tmp_path}/{name}")


@pytest.mark.parametrize("seed", [1, 2])
def test_late_rows_are_counted_in_their_place(spark, tmp_path, seed):
    rows = requests(400, seed)
    rng = random.Random(seed)
    # Files overlap in time: a row comes up to ten minutes after newer ones.
    shuffled = sorted(rows, key=lambda r: r[1] + timedelta(seconds=rng.random() * 600))
    parts = [shuffled[i : i + 60] for i in range(0, 400, 60)]
    stream = in_files(spark, f"{tmp_path}/in", parts)
    got = run(spark, ordered_session_numbers(stream, "user_id", 300, "15 minutes"), tmp_path, "numbers").collect()
    batch = req.session_metrics(spark.createDataFrame(rows, LOG), "user_id", ["timestamp", "request_id"], gap_seconds=300)
    wanted = {r.request_id: r for r in batch.collect()}
    newest = max(r[1] for r in rows)
    passed = {r[2] for r in rows if r[1] <= newest - timedelta(minutes=15)}
    assert {r.request_id for r in got} == passed and len(got) == len(passed) > 300
    for row in got:
        want = wanted[row.request_id]
        assert (row.user_id, row.requests, row.entities) == (want.user_id, want.requests, want.entities)
        assert row.mean_latency_ms == pytest.approx(want.mean_latency_ms) and row.sla_pct == pytest.approx(want.sla_pct)
    assert max(r.requests for r in got) > 5 and sum(r.requests == 1 for r in got) > 10


def test_many_sessions_share_a_state(spark, tmp_path):
    """Sessions of a group are counted apart, whatever their key; state and calls follow the groups."""
    rows = requests(500, 5, step=15.0, users=60)
    rows = [(None if r[0] is None else 2**60 + r[0], *r[1:2], r[2] if i % 50 else None, *r[3:]) for i, r in enumerate(rows)]
    stream = in_files(spark, f"{tmp_path}/in", [rows[:200], rows[200:350], rows[350:]])
    numbers = ordered_session_numbers(stream, "user_id", 900, "15 minutes", groups=2)
    with rocksdb_state(spark):
        query = live.write_table(numbers, f"{tmp_path}/numbers", f"{tmp_path}/state")
        query.awaitTermination()
    # Two values and a list, of two groups; counts, lists and timers are all that is kept.
    assert 0 < max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress) <= 20
    got = spark.read.schema(numbers.schema).parquet(f"{tmp_path}/numbers").collect()
    passed = [r for r in rows if r[1] <= max(r[1] for r in rows) - timedelta(minutes=15)]
    seen, wanted = {}, []
    for user, at, request, *_, latency, found in sorted(passed, key=lambda r: (r[1], r[2] or "")):
        last, n, entities, total = seen.get(user, (at, 0, 0, 0.0))
        if (at - last).total_seconds() > 900:
            n, entities, total = 0, 0, 0.0
        seen[user] = at, n + 1, entities + sum((found or {}).values()), total + latency
        wanted.append((user, request, *seen[user][1:3], round(seen[user][3] / (n + 1), 6)))
    key = lambda r: tuple(map(str, r))
    assert sorted(((r.user_id, r.request_id, r.requests, r.entities, round(r.mean_latency_ms, 6)) for r in got), key=key) == sorted(wanted, key=key)
    assert len(got) > 400 and max(r.requests for r in got) > 3 and any(r.user_id is None for r in got)


def test_state_is_forgotten_and_survives_restarts(spark, tmp_path):
    """Each run takes in one more file from the same checkpoint; a session that ended begins anew."""
    got = None
    for i, at in enumerate([0, 100, 50_000, 100_000]):
        rows = [(1, START + timedelta(seconds=at + k), f"r{i}{k}", "v1", "INFO", None, 10.0 + k, None) for k in range(3)]
        stream = in_files(spark, f"{tmp_path}/in", [rows])
        got = run(spark, ordered_session_numbers(stream, "user_id", 300, "1 minute"), tmp_path, "numbers")
    assert [r.requests for r in got.orderBy("at_us").collect()] == [1, 2, 3, 4, 5, 6, 1, 2, 3]
    assert spark.conf.get(PROVIDER) != "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def test_gap_in_batch(spark):
    rows = requests(300, 7)
    for group_rows in (20, None):
        got = req.session_metrics(spark.createDataFrame(rows, LOG), "user_id", ["timestamp", "request_id"], group_rows=group_rows, gap_seconds=120)
        found = {r.request_id: r.requests for r in got.collect()}
        last, count = {}, {}
        for row in sorted(rows, key=lambda r: r[1]):
            user, at = row[0], row[1]
            count[user] = count[user] + 1 if user in last and (at - last[user]).total_seconds() <= 120 else 1
            last[user] = at
            assert found[row[2]] == count[user]


def test_gauge_on_a_stream(spark, tmp_path):
    rows = requests(200, 3, step=45.0)
    stream = in_files(spark, f"{tmp_path}/in", [rows[:70], rows[70:140], rows[140:]])
    got = run(spark, active_requests_stream(stream, "model_version", 60, "5 minutes"), tmp_path, "gauge")
    for version in ("v0", "v1"):
        own = spark.createDataFrame([r for r in rows if r[3] == version], LOG)
        batch = {r.span_start: r[1:] for r in req.active_requests(own).select("span_start", "started", "ended", "in_flight").collect()}
        found = {r.span_start: (r.started, r.ended, r.in_flight) for r in got.filter(F.col("model_version") == version).collect()}
        assert found == {k: v for k, v in batch.items() if k <= max(found)} and len(found) > 100
        assert sorted(found) == list(range(min(found), max(found) + 60, 60))


def test_stream_and_late_rows_are_the_batch(spark, tmp_path):
    rows = requests(600, 5)
    late = [r for i, r in enumerate(rows) if i % 9 == 0]
    on_time = [r for i, r in enumerate(rows) if i % 9]
    cut = [on_time[i : i + 140] for i in range(0, len(on_time), 140)]
    # Late rows come three files after their own.
    parts = [*cut, late[:40], late[40:]]
    stream = in_files(spark, f"{tmp_path}/in", parts)
    keys = ["model_version"]
    counted = lambda df: df.groupBy(F.window("timestamp", "1 minute"), *keys).agg(F.count("*").alias("n"))
    streamed = run(spark, counted(live.watermarked(stream, "2 minutes")), tmp_path, "closed")
    path = f"{tmp_path}/late"
    for _ in range(2):  # a second run finds nothing new
        write_late_counts(stream, keys, "1 minute", "2 minutes", path, f"{tmp_path}/late-state").awaitTermination()
    found = accounted(counted(spark.createDataFrame(rows, LOG)), streamed, late_counts(spark, path, keys), keys, "n")
    newest = max(r[1] for r in rows).timestamp()
    closed = found.filter(F.unix_seconds("window.end") <= newest - 120).collect()
    assert all(r["all"] == r.streamed + r.late for r in closed) and len(closed) > 100
    assert sum(r.late for r in closed) > 30
