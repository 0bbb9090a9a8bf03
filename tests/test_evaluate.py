import math
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from corpuslab.operators import evaluate as ev


def f1_of(gold, pred, labels):
    out = {}
    for x in labels:
        hit = sum(g == p == x for g, p in zip(gold, pred))
        sizes = gold.count(x) + pred.count(x)
        out[x] = 2 * hit / sizes if sizes else 0.0
    return out


def sample(rng, classes, n):
    gold = [rng.choice([*classes, -100]) for _ in range(n)]
    return gold, [rng.choice(classes) if rng.random() < 0.4 or g < 0 else g for g in gold]


@pytest.fixture(scope="module")
def arrays(spark):
    rng = random.Random(4)
    rows = []
    for i, classes in enumerate([[0, 1, 2, 3, 4], [0, 1], [0], [0, 3, 4], [1, 2]] * 3):
        gold, a = sample(rng, classes, 30)
        rows.append((i, gold, a, [0] * 30))
    return spark.createDataFrame(rows, "s int, gold array<int>, a array<int>, b array<int>"), rows


def test_metrics_per_sample_and_model(arrays):
    df, rows = arrays
    pairs = ev.prediction_pairs(df, ["s"], {"A": "a", "B": "b"})
    got = {(r.s, r.model): r for r in ev.token_metrics(pairs, ["s", "model"]).collect()}
    report = ev.classification_report(pairs, ["s", "model"], ev.LABEL_IDS)
    macro = {(r.s, r.model): r.macro_f1 for r in ev.macro_f1(report, ["s", "model"]).collect()}
    weighted = {(r.s, r.model): r.weighted_f1 for r in ev.weighted_f1(report, ["s", "model"]).collect()}
    assert report.count() == len(rows) * 2 * 5
    for s, gold, a, b in rows:
        for model, pred in (("A", a), ("B", b)):
            kept = [(g, p) for g, p in zip(gold, pred) if g != -100]
            g, p = [x for x, _ in kept], [x for _, x in kept]
            f1 = f1_of(g, p, range(5))
            seen = set(g) | set(p)
            row = got[s, model]
            assert row.num_tokens == len(g) and row.correct == sum(x == y for x, y in kept)
            assert row.macro_f1 == pytest.approx(sum(f1[x] for x in seen) / len(seen))
            assert row.macro_f1_fixed == pytest.approx(sum(f1.values()) / 5) == macro[s, model]
            want = sum(f1[x] * g.count(x) for x in range(5)) / len(g)
            assert row.weighted_f1 == pytest.approx(want) == weighted[s, model]
            assert (row.chemical_f1, row.disease_f1) == (pytest.approx(f1[1]), pytest.approx(f1[3]))


def test_report_zero_division(spark):
    df = spark.createDataFrame([(0, [0, 0, 1], [0, 2, 0])], "s int, gold array<int>, a array<int>")
    pairs = ev.prediction_pairs(df, [], {"A": "a"})
    got = {r.label: (r.precision, r.recall, r.f1, r.support) for r in ev.classification_report(pairs, [], ev.LABEL_IDS).collect()}
    assert got[0] == (0.5, 0.5, 0.5, 2) and got[1] == (0, 0, 0, 1) and got[2] == (0, 0, 0, 0) and got[4] == (0, 0, 0, 0)
    assert {r.label for r in ev.classification_report(pairs, []).collect()} == {0, 1, 2}
    assert ev.token_accuracy(pairs, [], entities_only=True).first().accuracy == 0.0


def test_arrays_are_cut_to_the_shorter(spark):
    df = spark.createDataFrame([(0, [0, 1, 2], [0, 1])], "s int, gold array<int>, a array<int>")
    assert ev.prediction_pairs(df, ["s"], {"A": "a"}).count() == 2


def test_confusion_combines_before_the_shuffle(arrays):
    df, _ = arrays
    plan = ev.confusion(ev.prediction_pairs(df, [], {"A": "a"}), ["model"])._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert text.count("HashAggregate") == 2 and "partial_count" in text


def test_latency(spark):
    rng = random.Random(8)
    rows = [(m, i, rng.expovariate(0.05)) for m in "ab" for i in range(200)]
    df = spark.createDataFrame(rows, "model string, seq int, latency_ms double")
    kept = ev.skip_warmup(df, ["model"], "seq", 5)
    assert kept.count() == 390 and kept.agg({"seq": "min"}).first()[0] == 5
    for approximate in (False, True):
        for r in ev.latency_profile(kept, ["model"], approximate=approximate, group_rows=30).collect():
            x = [v for m, i, v in rows if m == r.model and i >= 5]
            assert r["mean"] == pytest.approx(np.mean(x)) and r["std"] == pytest.approx(np.std(x))
            if not approximate:
                want = np.percentile(x, [50, 95, 99])
                assert (r.p50, r.p95, r.p99) == tuple(pytest.approx(w) for w in want)


def test_comparison_and_targets(spark):
    values = {
        "teacher": {"macro_f1": 0.8657, "parameters": 107_723_525, "latency_mean_ms": 39.04},
        "student": {"macro_f1": 0.7606, "parameters": 66_366_725, "latency_mean_ms": 20.89},
    }
    rows = [(v, m, float(x)) for v, ms in values.items() for m, x in ms.items()]
    report = spark.createDataFrame(rows, "variant string, metric string, value double")
    got = ev.compare_to_baseline(report, "teacher").first()
    assert round(got.f1_retention_pct, 1) == 87.9 and round(got.param_reduction_pct, 1) == 38.4
    assert round(got.speedup, 2) == 1.87
    delta = {r.metric: r.points for r in ev.delta_table(report, "teacher", "student").collect()}
    assert delta["macro_f1"] == "-10.51"
    summary = spark.createDataFrame([(2.5, 0.02, 0.38, 20.0), (2.49, 0.019, 0.379, 19.9)], "speedup double, f1_drop double, sparsity double, latency_p95_ms double")
    checks = [tuple(r)[4:] for r in ev.target_checks(summary).collect()]
    assert checks == [(True, False, True, False), (False, True, False, True)]


def best_of(values, delta, patience):
    best, epoch, row, wait = 0.0, None, 0, 0
    for i, v in enumerate(values, 1):
        if v > best + delta:
            best, epoch, wait = v, i, 0
        else:
            wait += 1
            if patience is not None and wait >= patience:
                return epoch, best, i, True
    return epoch, best, len(values), False


def checkpoints(spark, runs, delta, patience, group_rows=None):
    rows = [(r, e, v) for r, values in enumerate(runs) for e, v in enumerate(values, 1)]
    df = spark.createDataFrame(rows, "run int, epoch int, val_macro_f1 double")
    got = ev.select_checkpoint(df, ["run"], delta, patience, group_rows).collect()
    return {r.run: (r.best_epoch, r.best_value, r.epochs_run, r.stopped_early) for r in got}


def test_checkpoint_of_the_recorded_history(spark):
    runs = [[0.7585, 0.8204, 0.8179, 0.8101, 0.7968]]
    assert checkpoints(spark, runs, 0.001, 3)[0] == (2, 0.8204, 5, True)
    assert checkpoints(spark, runs, 0.0, None)[0] == (2, 0.8204, 5, False)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(st.integers(0, 40).map(lambda x: x / 2000), min_size=1, max_size=30), min_size=1, max_size=12))
def test_checkpoint_equals_the_fold(spark, runs):
    for delta, patience in ((0.001, 3), (0.0, None), (0.002, 1)):
        want = {i: best_of(values, delta, patience) for i, values in enumerate(runs)}
        assert checkpoints(spark, runs, delta, patience) == want
        assert checkpoints(spark, runs, delta, patience, group_rows=5) == want


def test_distillation_loss(spark):
    rng = np.random.default_rng(3)
    n = 40
    t, s, gold = rng.normal(size=(n, 5)) * 3, rng.normal(size=(n, 5)) * 3, rng.integers(-1, 5, n)
    rows = [("r", int(g) if g >= 0 else -100, a.tolist(), b.tolist()) for g, a, b in zip(gold, t, s)]
    df = spark.createDataFrame(rows, "run string, gold int, teacher array<double>, student array<double>")
    log_softmax = lambda x: x - x.max(1, keepdims=True) - np.log(np.exp(x - x.max(1, keepdims=True)).sum(1, keepdims=True))
    keep = gold >= 0
    lt, ls = log_softmax(t[keep] / 4), log_softmax(s[keep] / 4)
    soft = (np.exp(lt) * (lt - ls)).sum(1).mean() * 16
    hard = -log_softmax(s[keep])[np.arange(keep.sum()), gold[keep]].mean()
    got = ev.distillation_loss(df, ["run"]).first()
    assert got.tokens == keep.sum() and got.loss == pytest.approx((soft + hard) / 2)


def test_distillation_loss_of_odd_rows(spark):
    one, nan = [1.0, 2.0], float("nan")
    rows = {
        "null": [(0, None, one)], "inner": [(0, [1.0, None], one)], "beyond": [(5, one, one)], "none": [(0, [], [])],
        "lengths": [(0, one, [1.0, 2.0, 3.0])], "nan": [(0, [nan, 1.0], one)], "student": [(0, one, None), (1, one, one)],
        "ignored": [(-100, one, one), (None, one, one)], "mixed": [(0, one, one), (0, None, one), (2, one, [3.0, 1.0, 2.0])],
    }
    df = spark.createDataFrame([(r, *x) for r, xs in rows.items() for x in xs], "run string, gold int, teacher array<float>, student array<float>")
    got = {r.run: (r.tokens, r.soft_loss, r.hard_loss) for r in ev.distillation_loss(df, ["run"]).collect()}
    low, third = math.log(1 + math.e), math.log(1 + math.exp(1) + math.exp(-1))
    near = lambda *x: pytest.approx(x, abs=1e-9)
    assert got["null"][:2] == got["inner"][:2] == (1, None) and got["null"][2] == pytest.approx(low)
    assert got["beyond"] == (1, 0.0, None) and got["none"] == (1, 0.0, None) and "ignored" not in got
    assert got["lengths"][:2] == (1, None) and got["lengths"][2] is not None and math.isnan(got["nan"][1])
    assert got["student"] == near(2, 0.0, low - 1)
    assert got["mixed"] == near(3, 0.0, (low + low + third) / 3)
    # The numbers of a token are worked out by Arrow batch, not by a lambda per number.
    assert "lambda" not in ev.distillation_loss(df, ["run"])._jdf.queryExecution().executedPlan().toString()


def test_alignment_by_word(spark):
    a = spark.createDataFrame([(1, 0, None, "c"), (1, 1, 0, "x"), (1, 2, 0, "y"), (1, 3, 1, "z")], "sample_id int, position int, word_idx int, a string")
    b = spark.createDataFrame([(1, 0, 0, "p"), (1, 1, 1, "q"), (1, 2, 1, "r"), (1, 3, 2, "s")], "sample_id int, position int, word_idx int, b string")
    assert sorted((r.a, r.b) for r in ev.align_by_word(a, b).collect()) == [("x", "p"), ("z", "q")]
    assert ev.align_by_position(a.drop("word_idx"), b.limit(2).drop("word_idx")).count() == 2


def test_alignments_of_odd_rows_share_one_packed_shuffle(spark, monkeypatch):
    """Repeats, nulls, unordered rows and other types of keys as joins treat them."""
    rng = random.Random(4)

    def side(n, extra):
        return [
            (rng.choice([None, "a", "b", "c", "d"]), rng.choice([None, *range(-3, 9)]), rng.choice([None, 0, 1, 2, 2**33]), rng.choice([None, "x", "yy", "é"]), extra)
            for _ in range(n)
        ]

    left, right = side(300, [1.5, None]), side(200, None)
    kind = "sample string, position {0}, word_idx {0}, piece string, extra array<double>"
    a = spark.createDataFrame(left, kind.format("bigint")).repartition(3)
    b = spark.createDataFrame(right, kind.format("bigint").replace("position bigint", "position int"))
    monkeypatch.setattr(ev, "PACK_ROWS", 7)
    monkeypatch.setattr(ev, "GIVEN_ROWS", 5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        both = ev.side_by_side(a, b, "sample")
        by_spot = ev.align_by_position(a.drop("word_idx"), b.drop("word_idx"), "sample", both)
        by_word = ev.align_by_word(a, b, "sample", both)
        assert by_spot.columns == ["sample", "position", "piece", "extra", "piece", "extra"]
        assert [f.dataType.simpleString() for f in by_spot.schema][:2] == ["string", "bigint"]
        spots = sorted(str(tuple(r)) for r in by_spot.collect())
        alone = sorted(str(tuple(r)) for r in ev.align_by_position(a.drop("word_idx"), b.drop("word_idx"), "sample").collect())
        words = {(r[0], r[1]): tuple(r) for r in by_word.collect()}
        assert by_word.count() == len(words)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    wanted = [(s, p, x, e, y, f) for s, p, _, x, e in left for t, q, _, y, f in right if s is not None and p is not None and (s, p) == (t, q)]
    assert spots == alone == sorted(map(str, wanted)) and len(wanted) > 300

    def firsts(rows):
        found = {}
        for s, p, w, x, e in rows:
            if s is not None and w is not None:
                found.setdefault((s, w), []).append((p, x, e))
        return found

    one, other = firsts(left), firsts(right)
    assert words.keys() == one.keys() & other.keys() and len(words) > 10
    for key, row in words.items():
        for rows, got in ((one[key], row[2:4]), (other[key], row[4:])):
            low = min((p for p, *_ in rows if p is not None), default=None)
            assert tuple(got) in [(x, e) for p, x, e in rows if p == low] if low is not None else got == (None, None)
    # The rows of both sides move once, packed, and no join sorts them one by one.
    plan = by_spot.select(F.lit(1)).unionByName(by_word.select(F.lit(1)))
    plan.collect()
    shown = plan._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    moved = [line for line in shown.splitlines() if "Exchange hashpartitioning(" in line]
    assert "Join" not in shown and len(moved) == 2 and sum("ReusedExchange" in line for line in moved) == 1


def test_word_without_positions_gives_nulls(spark):
    kind = "sample_id int, position int, word_idx int, "
    a = spark.createDataFrame([(1, None, 0, "x"), (1, None, 1, "y"), (1, 4, 1, "z")], kind + "a string")
    b = spark.createDataFrame([(1, 0, 0, "p"), (1, 1, 1, "q")], kind + "b string")
    assert sorted(tuple(r) for r in ev.align_by_word(a, b).collect()) == [(1, 0, None, "p"), (1, 1, "z", "q")]
    assert ev.align_by_word(a.limit(0), b).count() == 0 and ev.align_by_position(a, b.limit(0)).count() == 0
