import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from corpuslab.operators import evaluate as ev, regress as rg, vectors as vec

LONG = "run_id int, component string, variant string, metric string, value double"


def findings(spark, rows, **options):
    df = spark.createDataFrame([(r, c, "summary", m, float(v)) for r, c, m, v in rows], LONG)
    return rg.find_regressions(df, ["run_id"], **options)


def test_findings_at_the_limits(spark):
    rows = [
        (1, "optimization", "f1_degradation_pct", 2.0),
        (1, "optimization", "speedup_factor", 2.0),
        (1, "optimization", "sparsity_pct", 35.0),
        (1, "distillation", "f1_retention_pct", 85.0),
        (2, "optimization", "f1_degradation_pct", 2.01),
        (3, "distillation", "f1_retention_pct", 84.9),
        (4, "optimization", "f1_degradation_pct", 0.77),
        (4, "optimization", "speedup_factor", 2.5),
        (4, "optimization", "sparsity_pct", 10.0),
    ]
    found = findings(spark, rows)
    severity = {(r.run_id, r.metric): r.severity for r in found.collect()}
    assert [severity[1, m] for m in ("F1 Degradation", "Speedup Factor", "Sparsity", "F1 Retention")] == ["OK"] * 4
    # A missing metric counts as 0, a missing report has no findings.
    assert severity[2, "Speedup Factor"] == "MEDIUM" and (2, "F1 Retention") not in severity
    assert {k for k in severity if k[0] == 3} == {(3, "F1 Retention")}
    status = {r.run_id: r.overall_status for r in rg.overall_status(found, ["run_id"]).collect()}
    assert status == {1: "PASS", 2: "FAIL", 3: "WARN", 4: "PASS"}
    alerts = {r.run_id: (r.alerts_triggered, r.action_required) for r in rg.alert_summary(found, ["run_id"]).collect()}
    assert alerts == {1: (0, False), 2: (3, True), 3: (1, True), 4: (1, True)}
    message = found.filter("run_id = 4 and metric = 'F1 Degradation'").first()
    assert (message.value, message.threshold) == ("0.77%", "2.0%")
    assert message.message == "F1 degradation within range (0.77% < 2.0%)"
    assert rg.alerts(found).filter("run_id = 3").first().channel == "#ml-alerts"


def test_latency_limit_behind_its_flag(spark):
    rows = [(1, "optimization", "latency_ms", 50.01)]
    assert findings(spark, rows).filter("metric = 'Latency'").count() == 0
    assert findings(spark, rows, check_latency=True).filter("metric = 'Latency'").first().severity == "MEDIUM"


@pytest.mark.parametrize("group_rows", [4, 100_000])
def test_summary_compares_with_the_run_before(spark, group_rows):
    rows = [(r, "optimization", "int8", "macro_f1", 0.7 + r / 100) for r in range(20) if r != 7]
    rows += [(r, "distillation", "student", "parameters", 66_366_725.0) for r in (3, 4)]
    report = spark.createDataFrame(rows, LONG)
    found = rg.find_regressions(report, ["run_id"])
    got = {(r.run_id, r.metric): r for r in rg.evaluation_summary(report, found, "run_id", group_rows).collect()}
    assert got[0, "macro_f1"].change is None and got[8, "macro_f1"].change == pytest.approx(0.02)
    assert got[5, "macro_f1"].shown == "75.00%" and got[4, "parameters"].shown == "66,366,725"


def pruned(vectors, amount):
    flat = [(abs(x), i, j) for i, v in vectors for j, x in enumerate(v)]
    gone = {(i, j) for _, i, j in sorted(flat)[: round(amount * len(flat))]}
    return {i: [0.0 if (i, j) in gone else x for j, x in enumerate(v)] for i, v in vectors}


@settings(max_examples=8, deadline=None)
@given(
    st.lists(st.lists(st.integers(-4, 4).map(float), min_size=1, max_size=8), min_size=1, max_size=12),
    st.sampled_from([0.0, 0.1, 0.4, 0.5, 0.9, 1.0]),
)
def test_prune_with_ties(spark, values, amount):
    vectors = list(enumerate(values))
    df = spark.createDataFrame(vectors, "vec_id long, v array<double>")
    got = {r.vec_id: r.v for r in vec.prune_global(df, amount).collect()}
    assert got == pruned(vectors, amount)


def test_prune_shuffles_no_elements(spark):
    df = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(50)], "vec_id long, v array<float>")
    got = vec.prune_global(df, 0.4)
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    assert vec.sparsity(got, []).first().sparsity == 0.4
    assert vec.sparsity(df.limit(0), []).first().sparsity == 0.0


def test_int8(spark):
    rng = np.random.default_rng(0)
    values = rng.normal(size=(20, 16))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(values)], "vec_id int, v array<double>")
    rows = {r.vec_id: r for r in vec.quantize_int8(df).collect()}
    scale = (values.max() - values.min()) / 255
    zero = np.rint(-values.min() / scale)
    for i, v in enumerate(values):
        want = np.clip(np.rint(v / scale) + zero, 0, 255)
        assert rows[i].q == want.astype(int).tolist()
        assert np.abs(np.array(rows[i].restored) - v).max() <= scale * 0.51
    same = spark.createDataFrame([(0, [0.0, 0.0])], "vec_id int, v array<double>")
    assert vec.quantize_int8(same).first().restored == [0.0, 0.0]


def test_bit_budget():
    assert (vec.PolarConfig(128).sign_bits, vec.PolarConfig(128).corrections) == (300, 38)
    assert (vec.PolarConfig(64).sign_bits, vec.PolarConfig(64).corrections) == (147, 18)


def test_memory(spark):
    row = vec.memory_report(spark.range(8), [], vec.PolarConfig(128)).first()
    # 1 byte radius, 300 bits, 38 * 2 bits, 38 * 2 bytes per vector; 8 bytes of scale.
    assert row.compressed_bytes == 8 + 8 + 8 * 300 // 8 + 8 * 76 // 8 + 8 * 76
    big = vec.memory_report(spark.range(100_000), [], vec.PolarConfig(128)).first()
    assert round(big.compression_ratio, 2) == 2.06 and round(big.bits_per_element, 2) == 7.75


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(1)
    values = rng.normal(size=(60, 32)) * np.exp(rng.normal(size=(60, 1)) * 0.5)
    values[7] = 0.0
    rows = [(i, i % 3, v.tolist()) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "vec_id int, g int, v array<double>").repartition(3), values


def encode(values, config):
    """The whole table at once."""
    radius = np.linalg.norm(values, axis=1)
    directions = values / (radius[:, None] + 1e-8)
    matrix = config.projection()
    signs = directions @ matrix.T > 0
    approx = (2.0 * signs - 1) @ np.linalg.pinv(matrix).T
    approx /= np.linalg.norm(approx, axis=1, keepdims=True) + 1e-8
    rest = directions - approx
    idx = np.argsort(-np.abs(rest), axis=1, kind="stable")[:, : config.corrections]
    raw = np.take_along_axis(rest, idx, axis=1)
    c = np.abs(raw).max() + 1e-8
    step = (radius.max() - radius.min()) / 255
    codes = np.clip((radius - radius.min()) / (step + 1e-8), 0, 255).astype(int)
    corr = np.clip((raw / c + 1) * 1.5, 0, 3).astype(int)
    added = (corr / 1.5 - 1) * c
    direction = approx.copy()
    np.put_along_axis(direction, idx, np.take_along_axis(direction, idx, axis=1) + added, axis=1)
    direction /= np.linalg.norm(direction, axis=1, keepdims=True) + 1e-8
    return codes, signs, idx, corr, (codes * step + radius.min())[:, None] * direction


def test_polar_codes_and_decoding(spark, table):
    df, values = table
    config = vec.PolarConfig(32)
    codes, scales = vec.polar_encode(df, [config])
    radius, signs, idx, corr, restored = encode(values, config)
    for r in codes.collect():
        i = r.vec_id
        assert r.radius == radius[i] and list(r.corr) == corr[i].tolist() and list(r.idx) == idx[i].tolist()
        assert r.signs == np.packbits(signs[i]).tobytes()
    got = {r.vec_id: r.restored for r in vec.polar_decode(codes, scales, [config]).collect()}
    assert np.allclose([got[i] for i in range(60)], restored)
    assert max(corr.ravel()) <= 3
    packed = {r.vec_id: r.signs for r in vec.project_signs(df, config).collect()}
    directions = values / (np.linalg.norm(values, axis=1, keepdims=True) + 1e-8)
    assert packed[3] == np.packbits(directions[3] @ config.projection().T > 0).tobytes()


def test_polar_scales_per_group(spark, table):
    df, values = table
    config = vec.PolarConfig(32, 4.0)
    codes, scales = vec.polar_encode(df, [config], scale_by="g")
    assert scales.count() == 3
    got = {r.vec_id: r.restored for r in vec.polar_decode(codes, scales, [config], scale_by="g").collect()}
    group = [i for i in range(60) if i % 3 == 1]
    assert np.allclose([got[i] for i in group], encode(values[group], config)[4])


def test_sweep(spark, table):
    df, values = table
    rows = {r.bits: r for r in vec.bit_sweep(df.filter("vec_id <> 7"), 32, [2.0, 4.0, 8.0]).collect()}
    assert rows[2.0].cosine_mean < rows[4.0].cosine_mean and rows[2.0].compression_ratio > rows[8.0].compression_ratio
    kept = [i for i in range(60) if i != 7]
    for bits, row in rows.items():
        restored = encode(values[kept], vec.PolarConfig(32, bits))[4]
        dots = (restored * values[kept]).sum(1) / np.linalg.norm(restored, axis=1) / np.linalg.norm(values[kept], axis=1)
        assert row.cosine_mean == pytest.approx(dots.mean()) and row.vectors == 59


def test_quality(spark):
    df = spark.createDataFrame([([3.0, 4.0], [3.0, 4.0]), ([1.0, 0.0], [0.0, 1.0])], "v array<double>, restored array<double>")
    got = vec.restoration_quality(df, []).first()
    assert (got.cosine_mean, got.cosine_min, got.mse) == (0.5, 0.0, 0.5)
    assert got.relative_l2_error == pytest.approx(2**0.5 / 2)


def test_top_components(spark):
    df = spark.createDataFrame([([1.0, -3.0, 3.0, 0.5],)], "v array<double>")
    assert df.select(vec.top_components(F.col("v"), 3).alias("t")).first().t == [1, 2, 0]


def test_frame_of_signs():
    for rows in (32, 64, 96, 128):
        signs = vec.frame(rows, 32)
        assert set(np.unique(signs)) == {-1.0, 1.0}
        assert (signs.T @ signs == rows * np.eye(32)).all()
    assert len({tuple(r) for r in vec.frame(128, 32).tolist()}) == 128
    with pytest.raises(ValueError):
        vec.frame(40, 32)
    with pytest.raises(ValueError):
        vec.frame(48, 24)


def test_counts_in_the_row(spark):
    rows = [
        (1, "x", [0, 1, 3, -100, 4], [0, 1, 1, 0], [0, None, 3, 3]),
        (1, "x", [1], [1], [9]),
        (2, "x", [], [], []),
        (3, "x", [-100], [1], [1]),
        (4, "x", None, [1], [1]),
        (5, "x", [7, 7, 1], [7, 1, 1], [0, 0, 0]),
    ]
    df = spark.createDataFrame(rows, "id int, clash string, gold array<int>, pa array<int>, pb array<int>")
    counted = {r.id: r for r in ev.added_counts(ev.row_counts(df, ["id"], {"a": "pa", "b": "pb"}), ["id"]).collect()}
    tokens = ev.paired_rows(df, ["id"], {"a": "pa", "b": "pb"})
    plain = tokens.groupBy("id").agg(F.count("gold").alias("num_tokens"), *ev.metric_sums("a"), *ev.metric_sums("b"))
    assert {r.id: r.asDict() for r in plain.collect()} == {k: v.asDict() for k, v in counted.items()}
    got = ev.sample_metrics(df, ["id"], {"A": "pa", "B": "pb"})
    want = ev.token_metrics(ev.prediction_pairs(df, ["id"], {"A": "pa", "B": "pb"}), ["id", "model"])
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_worker_holds_few_vectors_at_a_time(spark, table):
    df, values = table
    config = vec.PolarConfig(32, 3.0)
    codes, scales = vec.polar_encode(df, [config])
    whole = {r.vec_id: r.restored for r in vec.polar_decode(codes, scales, [config]).collect()}
    frames = [pd.DataFrame({"x": range(2500)}), pd.DataFrame({"x": []}), pd.DataFrame({"x": range(3)})]
    assert [len(f) for f in vec.sliced(frames)] == [1000, 1000, 500, 3]
    assert len(whole) == len(values)
