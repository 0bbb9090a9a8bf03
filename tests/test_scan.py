import random

import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from corpuslab.operators import ranks, scan
from corpuslab.operators.skew import lookup_join, small_side


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def events(spark):
    """One key holds most rows, one key is null, the order has ties across blocks."""
    rng = random.Random(5)
    rows = []
    for i in range(900):
        key = None if i % 50 == 0 else ("hot" if i % 3 else f"k{i % 20}")
        mark = rng.randint(0, 9) if rng.random() < 0.3 else None
        rows.append((key, rng.randint(0, 60), i, rng.randint(-5, 9), mark))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "k string, at int, id int, v int, mark int"), rows


def values():
    return [
        scan.Running("total", "sum", F.col("v")),
        scan.Running("top", "max", F.col("v")),
        scan.Running("seen", "last", F.col("mark")),
        scan.Running("before", "previous", F.col("mark")),
        scan.running_count("row"),
    ]


def expected(rows, keyed):
    want, groups = {}, {}
    for row in rows:
        groups.setdefault(row[0] if keyed else 0, []).append(row)
    for group in groups.values():
        group.sort(key=lambda r: (r[1], r[2]))
        total, top, seen, before = 0, None, None, None
        for n, (_, _, i, v, mark) in enumerate(group, 1):
            total += v
            top = v if top is None else max(top, v)
            seen = seen if mark is None else mark
            want[i] = (total, top, seen, before, n)
            before = mark
    return want


@pytest.mark.parametrize("group_rows", [10, 100, 10_000])
@pytest.mark.parametrize("keyed", [True, False])
def test_running_values(events, group_rows, keyed):
    df, rows = events
    got = scan.running(df, ["k"] if keyed else [], ["at", "id"], values(), group_rows)
    found = {r.id: (r.total, r.top, r.seen, r.before, r.row) for r in got.collect()}
    assert found == expected(rows, keyed)


def test_oversized_group_is_split(events):
    df, _ = events
    blocked, blocks = scan.add_blocks(df, ["k"], "at", 50)
    sizes = blocked.groupBy("k", scan.BLOCK).count().collect()
    assert blocks >= 8 and max(r["count"] for r in sizes if r["k"] == "hot") < 200
    assert all(r[scan.BLOCK] == -1 for r in sizes if r["k"] not in ("hot",))
    assert scan.add_blocks(df, ["k"], "at", 10_000)[1] == 0


def test_running_without_keys_has_no_single_window(spark, events):
    df, _ = events
    got = scan.running(df, [], ["at", "id"], values(), 100)
    plan = got._jdf.queryExecution().executedPlan().toString()
    for part in plan.split("Window ")[1:]:
        assert "SinglePartition" not in part.split("Exchange", 2)[1][:80], plan


def test_mid_rank_with_ties_and_a_dominant_value(spark):
    rng = random.Random(1)
    rows = [(i, 7.0 if i % 3 == 0 else float(rng.randint(0, 40))) for i in range(600)] + [(600, None)]
    got = ranks.mid_rank(spark.createDataFrame(rows, "id int, x double"), "x", group_rows=50).collect()
    want = pd.Series({i: x for i, x in rows if x is not None}).rank(method="average")
    assert {r.id: r.mid_rank for r in got} == want.to_dict()


def test_percentiles_by_group(spark):
    rng = random.Random(2)
    rows = [(f"g{i % 3}", round(rng.expovariate(0.1), 1)) for i in range(500)] + [("one", 4.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    fractions = {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    frame = pd.DataFrame(rows, columns=["g", "x"])
    for group_rows in (20, 100_000):
        for row in ranks.percentiles(df, ["g"], "x", fractions, group_rows).collect():
            values = frame[frame.g == row.g].x
            for name, q in fractions.items():
                assert row[name] == pytest.approx(values.quantile(q))
    whole = ranks.percentiles(df, [], "x", fractions, 20).first()
    assert whole.p95 == pytest.approx(frame.x.quantile(0.95))
    near = ranks.nearest_ranks(df, ["g"], "x", {"p95": 0.95}).collect()
    for row in near:
        values = sorted(frame[frame.g == row.g].x)
        assert row.p95 == values[min(int(len(values) * 0.95), len(values) - 1)]


@settings(max_examples=8, deadline=None)
@given(
    values=st.lists(st.tuples(st.integers(-30, 30), st.integers(0, 4)), min_size=1, max_size=120),
    data=st.data(),
)
def test_select_rank(spark, values, data):
    flat = sorted(v for v, w in values for _ in range(w))
    df = spark.createDataFrame(values, "v int, w int")
    rank = data.draw(st.integers(1, len(flat) + 1))
    got = ranks.select_rank(df, "v", rank, weight="w", buckets=4, gather=3)
    if rank > len(flat):
        assert got is None
    else:
        assert got == (flat[rank - 1], sum(v < flat[rank - 1] for v in flat))


def test_first_n(spark, monkeypatch):
    df = spark.range(0, 500).select((F.col("id") * 7 % 501).alias("k"))
    plain = sorted(r.k for r in ranks.first_n(df, "k", 40).collect())
    monkeypatch.setattr(ranks, "TOP_N", 10)
    assert sorted(r.k for r in ranks.first_n(df, "k", 40).collect()) == plain
    assert ranks.first_n(df, "k", 9_999).count() == 500
    texts = df.select(F.concat(F.when(F.col("k") % 5 == 0, "pmid_é").otherwise("pmid_"), F.col("k").cast("string")).alias("t"))
    ordered = sorted((r.t for r in texts.collect()), key=str.encode)
    for n in (11, 40, 333, 500):
        assert sorted((r.t for r in ranks.first_n(texts, "t", n).collect()), key=str.encode) == ordered[:n]
    assert ranks.first_n(texts, "t", 501).count() == 500


def test_lookup_join_keeps_every_row(spark):
    rows = [("the" if i % 2 else f"w{i % 37}", i) for i in range(400)]
    big = spark.createDataFrame(rows, "w string, i int")
    lookup = big.groupBy("w").agg(F.count("*").alias("n"))
    for hot in (3, 1000):
        got = lookup_join(big, lookup, "w", "n", hot_rows=hot)
        assert sorted(r.i for r in got.collect()) == list(range(400))
        assert got.filter("w = 'the' and n = 200").count() == 200


def test_small_side_is_checked(spark):
    df = spark.range(50)
    assert "broadcast" in plan_of(small_side(df, 50)).lower() or small_side(df, 50).count() == 50
    assert small_side(df, 10) is df
