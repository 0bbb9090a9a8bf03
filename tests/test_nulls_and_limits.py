"""Null groups, malformed input, and results that must not depend on a size."""

import math
import time
import tracemalloc
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from corpuslab.functions import stats
from corpuslab.operators import corpusstats, evaluate, ranks, regress as rg, requests as req
from corpuslab.sources import files


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, v) for v in r))


@pytest.mark.parametrize("n", [3, 9, 10, 11, 60, 61, 99, 150, 201])
def test_first_n_is_one_definition(spark, n):
    rows = [(None if i % 5 == 0 else i % 7, f"t{i % 3}" if i % 4 else None, i) for i in range(200)]
    df = spark.createDataFrame(rows, "k int, t string, i int").repartition(3)
    for order in (["k"], ["k", "t"], ["t", "k", "i"], ["i"]):
        # Whether selected or limited, the same rows come back, also among ties.
        plain = ranks.first_n(df, order, n, gather=1_000).collect()
        chosen = ranks.first_n(df, order, n, gather=0 if n < 100 else 5).collect()
        assert len(plain) == len(chosen) == min(n, 200)
        assert sorted(r.i for r in plain) == sorted(r.i for r in chosen)
        names = [ordered([tuple(r[c] for c in order) for r in part]) for part in (plain, rows_as(df, order))]
        assert names[0] == names[1][: min(n, 200)]


def rows_as(df, order):
    return df.select(*order).collect()


def test_null_groups_stay(spark):
    rows = [(m, i, float(i)) for m in ("a", None) for i in range(20)]
    df = spark.createDataFrame(rows, "model string, i int, latency_ms double")
    profile = {r.model: (r.runs, r.p50) for r in evaluate.latency_profile(df, ["model"]).collect()}
    assert profile == {"a": (20, 9.5), None: (20, 9.5)}
    assert [(r.runs, r.p50) for r in evaluate.latency_profile(df, []).collect()] == [(40, 9.5)]
    kept = evaluate.skip_warmup(df, ["model"], "i", 5)
    assert {(r.model, r["count"]) for r in kept.groupBy("model").count().collect()} == {("a", 15), (None, 15)}
    bins = corpusstats.histogram(df, ["model"], "latency_ms", 4).collect()
    assert sorted((str(r.model), r.bin, r.n) for r in bins) == [(m, b, 5) for m in ("None", "a") for b in range(4)]
    load = df.withColumn("status", F.lit("success"))
    assert {r.model: r.p95_ms for r in req.load_test_summary(load, ["model"]).collect()} == {"a": 19.0, None: 19.0}


def test_rows_without_a_request_id_stay(spark):
    rows = [("x", 1), ("x", 2), (None, 1), (None, 1)]
    df = spark.createDataFrame(rows, "request_id string, n int").withColumn("timestamp", F.timestamp_seconds("n"))
    got = sorted((str(r.request_id), r.n) for r in req.first_per_request(df).collect())
    assert got == [("None", 1), ("None", 1), ("x", 1)]


def test_unrated_documents(spark):
    df = spark.createDataFrame([(1, 2, ["a"]), (None, 3, ["b", "a"]), (None, 1, [])], "rating int, word_count int, filtered_words array<string>")
    assert corpusstats.corpus_statistics(df).first().rating_distribution == {"1": 1, "None": 2}


def test_malformed_lines_are_counted_apart(spark, tmp_path):
    good = '{"timestamp": "2024-01-01T00:00:00Z", "level": "INFO", "model_version": "v1", "latency_ms": 1.0}'
    (tmp_path / "log.json").write_text("\n".join([good, good[:40], "not json", good]))
    log = files.read_request_log(spark, str(tmp_path))
    got = {(r.model_version, r.status): r.requests for r in req.request_counts(log).collect()}
    assert got.pop(("v1", "success")) == 2
    assert set(k[1] for k in got) == {"malformed"} and sum(got.values()) == 2


def test_empty_files_have_a_row(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"")
    (tmp_path / "b.txt").write_text("  é text\n\n")
    (tmp_path / "c.txt").write_text(" \n ")
    got = {r.path.rsplit("/", 1)[1]: (r.text, r.error) for r in files.read_text_files(spark, str(tmp_path)).collect()}
    assert got == {"a.txt": (None, "File is empty"), "b.txt": ("é text", None), "c.txt": (None, "File is empty")}


def test_reports_of_any_depth(spark):
    report = '{"x": 1, "s": {"y": 2, "t": {"z": 3, "u": {"w": 4.5, "v": {"q": 6}}}}, "n": null, "e": {}, "a": "text"}'
    df = spark.createDataFrame([(1, report)], "run int, report string")
    got = {(r.variant, r.metric): r.value for r in files.flatten_reports(df).collect()}
    assert got == {("", "x"): 1, ("s", "y"): 2, ("t", "z"): 3, ("t.u", "w"): 4.5, ("t.u.v", "q"): 6}


@pytest.mark.parametrize("scale", [1e-7, 1.0, 2e12])
def test_means_of_any_scale(spark, scale):
    values = [scale * i for i in range(1, 30)]
    df = spark.createDataFrame(list(enumerate(values)), "i int, x double")
    got = {r.i: r.x_rolling for r in corpusstats.rolling_mean(df, "i", ["x"], window=2).collect()}
    assert got[0] is None
    assert all(math.isclose(got[i], (values[i] + values[i - 1]) / 2, rel_tol=1e-12) for i in range(1, 29))
    log = df.select(F.lit("s").alias("s"), "i", F.col("x").alias("latency_ms"), F.lit(None).cast("map<string,int>").alias("entity_counts"))
    last = req.session_metrics(log, "s", ["i"]).filter("i = 28").first()
    assert math.isclose(last.mean_latency_ms, sum(values) / 29, rel_tol=1e-12)


def test_values_that_are_no_numbers(spark):
    df = spark.createDataFrame([(0, 1.0), (1, None), (2, 3.0)], "i int, x double")
    assert [r.x_rolling for r in corpusstats.rolling_mean(df, "i", ["x"], window=3).orderBy("i").collect()] == [None, None, 4 / 3]


def exact_tail(a, b, larger):
    """Counts of U by the plain recursion on sizes."""
    table = {}

    def ways(m, n):
        if not m or not n:
            return {0: 1}
        if (m, n) not in table:
            out = dict(ways(m, n - 1))
            for u, c in ways(m - 1, n).items():
                out[u + n] = out.get(u + n, 0) + c
            table[m, n] = out
        return table[m, n]

    counts = ways(a, b)
    return min(1.0, 2 * sum(c for u, c in counts.items() if u >= larger) / sum(counts.values()))


@pytest.mark.parametrize("sizes", [(1, 1), (3, 4), (8, 8), (5, 40), (8, 60)])
def test_rank_sum_tails(sizes):
    a, b = sizes
    for larger in {a * b, a * b - 1, (a * b + 1) // 2, a * b // 2 + 2}:
        assert stats.rank_sum_exact(a, b, larger) == pytest.approx(exact_tail(a, b, larger), rel=1e-9)


def test_tiny_sample_is_exact_beside_a_large_one(spark):
    df = spark.range(10_000).select(
        F.lit(8).alias("a"), (F.lit(500) + F.col("id") % 3).alias("b"), F.lit(3900.0).alias("u"), F.lit(0.1).alias("z"), F.lit(False).alias("t")
    )
    began = time.monotonic()
    got = {r.b: r.p for r in df.select("b", stats.rank_sum_p("a", "b", "u", "z", "t").alias("p")).distinct().collect()}
    assert time.monotonic() - began < 60
    assert got[501] == pytest.approx(stats.rank_sum_exact(8, 501, 3900.0), rel=1e-9)
    # Far from the normal tail of z, which such sizes used to get.
    assert got[501] < 1e-5


def test_rank_sum_ways_count_all_arrangements():
    for smaller, larger in [(0, 4), (1, 9), (2, 5), (3, 3), (3, 7), (4, 6), (5, 5)]:
        sums = [sum(at) - smaller * (smaller - 1) // 2 for at in combinations(range(smaller + larger), smaller)]
        for u in range(smaller * larger + 1):
            assert stats.rank_sum_ways(smaller, larger, u) == sum(x <= u for x in sums)


def test_rank_sum_of_a_huge_sample_in_little_memory():
    n = 100_000_000
    tracemalloc.start()
    values = [stats.rank_sum_exact(8, n, u * 8 * n) for u in (0.5, 0.75, 0.9, 1.0)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20_000_000
    # U over n is nearly a sum of 8 uniform values.
    below = lambda x: sum((-1) ** k * math.comb(8, k) * (x - k) ** 8 for k in range(int(x) + 1)) / math.factorial(8)
    assert values[0] == 1.0 and values[3] == pytest.approx(2 / math.comb(n + 8, 8), rel=1e-12)
    assert values[1:3] == pytest.approx([2 * below(2.0), 2 * below(0.8)], rel=1e-5)


def test_worst_variant_is_judged_and_named(spark):
    rows = [
        (1, "optimization", "pruned", "speedup_factor", 3.0),
        (1, "optimization", "int8", "speedup_factor", 0.5),
        (1, "ab", "int8", "speedup_factor", 9.0),
        (2, "optimization", "summary", "speedup_factor", 2.5),
        (2, "optimization", "int8", "speedup_factor", 0.5),
        (3, "optimization", "int8", "f1_degradation_pct", 1.0),
        (3, "optimization", "pruned", "f1_degradation_pct", 2.5),
    ]
    report = spark.createDataFrame(rows, "run_id int, component string, variant string, metric string, value double")
    found = rg.find_regressions(report, ["run_id"])
    got = {(r.run_id, r.metric_key): (r.severity, r.value, r.variant_key) for r in found.collect()}
    assert got[1, "speedup_factor"] == ("MEDIUM", "0.50x", "int8")
    assert got[2, "speedup_factor"] == ("OK", "2.50x", "summary")
    assert got[3, "f1_degradation_pct"] == ("HIGH", "2.50%", "pruned")
    summary = rg.evaluation_summary(report, found, "run_id").collect()
    noted = {(r.run_id, r.component, r.variant, r.metric) for r in summary if r.severity is not None}
    assert noted == {(1, "optimization", "int8", "speedup_factor"), (2, "optimization", "summary", "speedup_factor"), (3, "optimization", "pruned", "f1_degradation_pct")}
