import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from corpuslab.functions import stats
from corpuslab.operators import experiment as ex


def test_tails_against_published_tables():
    for freedom, want in ((1, 12.706205), (2, 4.302653), (10, 2.228139), (30, 2.042272), (99, 1.984217), (10_000, 1.960201)):
        assert stats.t_quantile(0.975, freedom) == pytest.approx(want, abs=2e-6)
    assert stats.t_quantile(0.995, 5) == pytest.approx(4.032143, abs=2e-6)
    assert stats.normal_two_sided(1.959963985) == pytest.approx(0.05)
    assert stats.signed_rank_exact(10, 8) == pytest.approx(50 / 1024)
    assert stats.rank_sum_exact(5, 5, 23) == pytest.approx(8 / 252)
    assert stats.rank_sum_exact(3, 4, 6) == 1.0
    assert stats.incomplete_beta(2, 3, 0.5) == pytest.approx(0.6875)


def make_log(spark, experiments):
    rows = [
        (e, i, a, b, x, y) for e, samples in experiments.items() for i, (a, b, x, y) in enumerate(samples)
    ]
    return spark.createDataFrame(
        rows, "experiment_id string, sample_id int, latency_a_ms double, latency_b_ms double, f1_a double, f1_b double"
    )


@pytest.fixture(scope="module")
def experiments():
    rng = random.Random(7)
    out = {}
    for name, n in (("big", 120), ("ties", 60), ("small", 7), ("eleven", 11), ("ten", 10)):
        samples = []
        for i in range(n):
            a, b = round(rng.gauss(30, 5), 3), round(rng.gauss(29, 5), 3)
            x, y = round(rng.random(), 4), round(rng.random(), 4)
            if name == "ties":
                a, b, x, y = round(a, 0), round(b, 0), round(x, 1), round(y, 1)
            samples.append((a, b, x, y))
        out[name] = samples
    out["same"] = [(5.0, 5.0, 0.5, 0.5)] * 30
    out["one"] = [(5.0, 6.0, 0.5, 0.4)]
    return out


def rank_sum(samples):
    a, b = [s[0] for s in samples], [s[1] for s in samples]
    r = pd.Series(a + b).rank().to_numpy()
    u = r[: len(a)].sum() - len(a) * (len(a) + 1) / 2
    counts = pd.Series(a + b).value_counts()
    n = len(a) + len(b)
    spread = math.sqrt(len(a) * len(b) / 12 * (n + 1 - (counts**3 - counts).sum() / (n * (n - 1))))
    z = (max(u, len(a) * len(b) - u) - len(a) * len(b) / 2 - 0.5) / spread if spread else None
    return u, z, bool((counts > 1).any())


@pytest.mark.parametrize("group_rows", [20, 100_000])
def test_mann_whitney(spark, experiments, group_rows):
    log = make_log(spark, experiments)
    got = {r.experiment_id: r for r in ex.mann_whitney(log, ex.EXPERIMENT, "latency_a_ms", "latency_b_ms", group_rows).collect()}
    for name, samples in experiments.items():
        u, z, ties = rank_sum(samples)
        assert got[name].u_statistic == u
        if z is not None:
            assert got[name].z == pytest.approx(z)
        if name in ("big", "ties"):
            assert got[name].p_value == pytest.approx(min(1, math.erfc(z / math.sqrt(2))))
    assert got["same"].p_value == 1.0
    u = rank_sum(experiments["small"])[0]
    assert got["small"].p_value == pytest.approx(stats.rank_sum_exact(7, 7, max(u, 49 - u)))


@pytest.mark.parametrize("group_rows", [20, 100_000])
def test_wilcoxon(spark, experiments, group_rows):
    log = make_log(spark, experiments)
    got = {r.experiment_id: r for r in ex.wilcoxon(log, ex.EXPERIMENT, "f1_a", "f1_b", group_rows=group_rows).collect()}
    assert set(got) == {"big", "ties", "eleven"}
    for name, row in got.items():
        d = np.array([x - y for _, _, x, y in experiments[name]])
        d = d[d != 0]
        r = pd.Series(np.abs(d)).rank().to_numpy()
        plus, minus = r[d > 0].sum(), r[d < 0].sum()
        assert (row.pairs, row.w_plus, row.w_minus) == (len(d), plus, minus)
        if name == "eleven":
            assert row.p_value == pytest.approx(stats.signed_rank_exact(11, min(plus, minus)))
    rounded = ex.wilcoxon(log.filter("experiment_id = 'ties'"), ex.EXPERIMENT, "f1_a", "f1_b", round_to=4).first()
    assert rounded.ties > got["ties"].ties


def test_report_and_verdict(spark, experiments):
    log = make_log(spark, experiments)
    report = {(r.experiment_id, r.metric): r for r in ex.ab_report(log).collect()}
    assert len(report) == 2 * len(experiments)
    for name in ("same", "ten", "small", "one"):
        row = report[name, "f1_score"]
        assert (row.statistic, row.p_value, row.significant) == (0.0, 1.0, False)
    assert report["same", "latency"].winner == "tie" and report["same", "f1_score"].winner == "tie"
    one = report["one", "latency"]
    assert (one.mean_difference, one.ci_low, one.ci_high, one.winner) == (-1.0, -1.0, -1.0, "A")
    compat = {(r.experiment_id, r.metric): r.winner for r in ex.ab_report(log, compat=True).collect()}
    assert compat["one", "latency"] == "B"
    d = np.array([a - b for a, b, _, _ in experiments["big"]])
    half = stats.t_quantile(0.975, 119) * d.std(ddof=1) / math.sqrt(120)
    assert report["big", "latency"].ci_high == pytest.approx(d.mean() + half, abs=0.006)


def test_recommendation_bands(spark):
    rows = [(0.9, 0.81, 1.25), (0.9, 0.809, 0.0), (0.9, 0.719, 0.0), (0.9, 0.5, 0.0), (0.0, 0.5, 0.0)]
    df = spark.createDataFrame(rows, "a double, b double, ms double")
    retention, text = ex.verdict(F.col("a"), F.col("b"), F.col("ms"))
    got = [tuple(r) for r in df.select(retention, text).collect()]
    assert [g[0] for g in got] == [90.0, 89.9, 79.9, 55.6, 0.0]
    assert got[0][1] == "DEPLOY Student — retains 90.0% of teacher F1 with 1.3ms faster inference"
    assert got[1][1].endswith("acceptable for most use cases") and got[2][1].endswith("latency-critical deployments")
    assert got[3][1] == got[4][1].replace("0.0%", "55.6%") and "only" in got[3][1]


def test_experiment_log(spark):
    arms = spark.createDataFrame(
        [("e", 1, [-100, 1, 2, 0], [0, 1, 2, 0], [0, 1, 0, 0]), ("e", 2, [-100], [0], [0]), ("e", 3, [], [], [])],
        "experiment_id string, sample_id int, gold array<int>, pred_a array<int>, pred_b array<int>",
    )
    times = spark.createDataFrame([(i, 10.12345, 5.0) for i in (1, 2, 3)], "sample_id int, latency_a_ms double, latency_b_ms double")
    got = {r.sample_id: r for r in ex.experiment_log(arms, times, ["experiment_id", "sample_id"]).collect()}
    assert (got[1].num_tokens, got[1].correct_a, got[1].correct_b, got[1].accuracy_b) == (3, 3, 2, 0.6667)
    assert (got[1].f1_a, got[1].f1_b, got[1].latency_a_ms) == (1.0, 0.5556, 10.123)
    for empty in (got[2], got[3]):
        assert (empty.num_tokens, empty.accuracy_a, empty.f1_a) == (0, 0.0, 0.0)
    means = {(r.arm, r.metric): r.value for r in ex.run_means(ex.experiment_log(arms, times, ["experiment_id", "sample_id"])).collect()}
    assert means["B", "latency_ms"] == 5.0


def test_assignment_does_not_depend_on_partitions(spark):
    df = spark.range(1000).withColumn("g", ex.assigned_group(F.col("id")))
    first = {r.id: r.g for r in df.collect()}
    again = {r.id: r.g for r in spark.range(1000).repartition(7).withColumn("g", ex.assigned_group(F.col("id"))).collect()}
    assert first == again and 400 < sum(g == "A" for g in first.values()) < 600
