import random

import pyarrow as pa
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from corpuslab.catalog.tokens import cut_pieces, predictions, rule_predictor
from corpuslab.operators import labelling as lab

SCHEMA = "doc_id string, tokens array<struct<position:int,token:string,label_id:int,confidence:double>>"


def spans_of(tokens, strict=False):
    """Tokens in order: B- opens, I- extends what is open, anything else closes."""
    spans, current = [], None
    previous = None
    for position, token, label, confidence in tokens:
        if token in lab.SPECIAL_TOKENS:
            continue
        kind = lab.LABELS[label]
        other = strict and previous is not None and lab.LABELS[previous][2:] != kind[2:]
        previous = label
        if kind.startswith("B-"):
            if current:
                spans.append(current)
            current = [token.replace("##", ""), kind[2:], position, position, round(confidence, 4)]
        elif kind.startswith("I-") and current and not other:
            current[0] += token.replace("##", "")
            current[3] = position
            current[4] = min(current[4], round(confidence, 4))
        else:
            if current:
                spans.append(current)
            current = None
    if current:
        spans.append(current)
    return [tuple(s) for s in spans]


def decoded(spark, docs, strict=False):
    rows = [(str(i), tokens) for i, tokens in enumerate(docs)]
    got = lab.span_rows(lab.decode_spans(spark.createDataFrame(rows, SCHEMA), strict)).collect()
    return sorted((int(r.doc_id), r.text, r.label, r.start, r.end, r.confidence) for r in got)


def wanted(docs, strict=False):
    return sorted((i, *s) for i, tokens in enumerate(docs) for s in spans_of(tokens, strict))


def sentence(labels, tokens=None):
    tokens = tokens or [f"t{i}" if i % 3 else f"##t{i}" for i in range(len(labels))]
    return [(i, t, x, round(0.5 + i / 100, 4)) for i, (t, x) in enumerate(zip(tokens, labels))]


CASES = [
    [],
    sentence([0, 0, 0]),
    sentence([2, 4, 0, 2]),  # orphan I-
    sentence([1, 2, 4, 0]),  # type changes inside
    sentence([1, 1, 3, 3]),  # adjacent
    sentence([0, 3, 4]),  # at the end
    sentence([1, 0, 2], ["aa", "[SEP]", "##bb"]),  # special token inside
    sentence([1, 0, 2]),
]


def test_decoding_cases(spark):
    assert decoded(spark, CASES) == wanted(CASES)
    assert decoded(spark, CASES, strict=True) == wanted(CASES, strict=True)
    assert [s[1] for s in wanted(CASES) if s[0] == 6] == ["aabb"]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(st.integers(0, 4), max_size=25), min_size=1, max_size=25))
def test_decoding_equals_the_model(spark, labels):
    docs = [sentence(x) for x in labels]
    assert decoded(spark, docs) == wanted(docs)
    assert decoded(spark, docs, strict=True) == wanted(docs, strict=True)


def test_token_rows_of_a_long_document(spark):
    rng = random.Random(3)
    docs = [sentence([rng.choice([0, 1, 2, 2, 3, 4, 4]) for _ in range(n)]) for n in (700, 12, 40)]
    rows = [(str(d), *token) for d, doc in enumerate(docs) for token in doc]
    df = spark.createDataFrame(rows, "doc_id string, position int, token string, label_id int, confidence double")
    for group_rows in (60, 100_000):
        got = lab.decode_token_rows(df, ["doc_id"], group_rows).collect()
        assert sorted((int(r.doc_id), r.text, r.label, r.start, r.end, r.confidence) for r in got) == wanted(docs)


def test_prediction_builds_the_model_once_per_task(spark):
    built = spark.sparkContext.accumulator(0)

    def factory():
        built.add(1)
        return rule_predictor()

    texts = spark.createDataFrame([(str(i), f"alpha beta{i} gamma") for i in range(40)], "doc_id string, text string")
    got = lab.token_rows(lab.predict_tokens(texts.repartition(2), factory, batch_size=3))
    assert got.filter("token = '[CLS]'").count() == 40
    assert built.value == 2
    assert {r.position for r in got.filter("doc_id = '7'").collect()} == set(range(8))


def test_silver_labels_and_report(spark):
    docs = [
        [(0, "a", 1, 0.9), (1, "##b", 2, 0.86), (2, "c", 3, 0.5), (3, "d", 0, 0.4)],
        [(0, "x", 0, 0.9)],
        [(0, "p", 3, 0.85), (1, "q", 2, 0.84999)],
    ]
    df = lab.decode_spans(spark.createDataFrame([(str(i), d) for i, d in enumerate(docs)], SCHEMA))
    rows = {r.doc_id: r for r in lab.silver_labels(df).collect()}
    assert (rows["0"].tokens, rows["0"].tags) == (["a", "##b", "c", "d"], [1, 2, 0, 0])
    assert (rows["0"].num_entities, rows["0"].avg_confidence) == (1, 0.86)
    assert (rows["1"].num_entities, rows["1"].avg_confidence) == (0, 0.0)
    assert rows["2"].tags == [3, 2]  # 0.84999 rounds to 0.85
    assert (rows["2"].num_entities, rows["2"].avg_confidence) == (1, 0.85)
    report = lab.label_report(df).first()
    assert (report.total_abstracts, report.total_entities, report.high_confidence_entities) == (3, 3, 2)
    assert report.entity_counts == {"Chemical": 1, "Disease": 1}
    summary = {r.doc_id: r for r in lab.document_summary(df).collect()}
    assert summary["0"].entity_summary == {"Chemical": 1, "Disease": 1} and summary["1"].entities_found == 0
    none = lab.label_report(df.limit(0)).first()
    assert (none.total_entities, none.filter_rate_pct) == (0, 0.0)


def test_model_agreement(spark):
    schema = "doc_id string, spans array<struct<start:int,end:int,label:string>>"
    a = spark.createDataFrame(
        [("1", [(0, 1, "Chemical"), (4, 4, "Disease")]), ("2", [(1, 1, "Disease")]), ("4", []), (None, [(0, 0, "Disease")])], schema
    )
    b = spark.createDataFrame([("1", [(0, 1, "Chemical"), (4, 4, "Chemical")]), ("3", [(0, 0, "Disease")]), ("4", [])], schema)
    got = {r.doc_id: (r.entities_a, r.entities_b, r.both, r.only_a, r.only_b) for r in lab.compare_models(a, b).collect()}
    # A document without spans stays.
    assert got == {"1": (2, 2, 1, 1, 1), "2": (1, 0, 0, 1, 0), "3": (0, 1, 0, 0, 1), "4": (0, 0, 0, 0, 0), None: (1, 0, 0, 1, 0)}


def test_ignored_stretches_are_not_gathered(spark):
    rows = [("1", i, "x", 2, 0.9) for i in range(300)] + [("1", 300, "a", 1, 0.9), ("1", 301, "##b", 2, 0.8), ("1", 302, "c", 0, 0.9)]
    df = spark.createDataFrame(rows, "doc_id string, position int, token string, label_id int, confidence double")
    assert [(r.text, r.start, r.end) for r in lab.decode_token_rows(df, ["doc_id"]).collect()] == [("ab", 300, 301)]


def test_alignment_padding_softmax(spark):
    df = spark.createDataFrame([([1, 0, 3, 2], [None, 0, 0, 1, 2, 2, 3, 3, None])], "tags array<int>, w array<int>")
    got = df.select(
        lab.align_labels(F.col("tags"), F.col("w")).alias("l"),
        lab.pad(F.col("tags"), 6, 9).alias("long"),
        lab.pad(F.col("tags"), 2).alias("short"),
        lab.attention_mask(F.col("tags"), 6).alias("mask"),
        lab.truncate(F.col("tags"), 3).alias("cut"),
    ).first()
    assert got.l == [-100, 1, 2, 0, 3, 4, 2, 2, -100]
    assert (got.long, got.short, got.mask, got.cut) == ([1, 0, 3, 2, 9, 9], [1, 0], [1, 1, 1, 1, 0, 0], [1, 0, 3])
    logits = spark.createDataFrame([([1.0, 3.0, 3.0],), ([0.0, 0.0],), ([1000.0, -1000.0],)], "x array<double>")
    rows = logits.select(
        lab.predicted_class(F.col("x")).alias("c"), F.round(lab.predicted_probability(F.col("x")), 4).alias("p")
    ).collect()
    assert [(r.c, r.p) for r in rows] == [(1, 0.4683), (0, 0.5), (0, 1.0)]


def test_tokens_of_long_texts_are_held_in_parts(spark):
    """Each label is the number of results alive when it was made."""

    def factory():
        alive = [0]

        class Found(list):
            def __init__(self, rows):
                super().__init__(rows)
                alive[0] += 1

            def __del__(self):
                alive[0] -= 1

        def predict(texts):
            return [Found([("x", alive[0], 1.0)]) for _ in texts]

        return predict

    size = lab.PART_CHARS // 10
    docs = spark.range(200).selectExpr("CAST(id AS STRING) AS doc_id", f"repeat('a', {size}) AS text").coalesce(1)
    rows = lab.token_rows(lab.predict_tokens(docs, factory)).select("doc_id", "label_id").collect()
    assert len({r["doc_id"] for r in rows}) == len(rows) == 200
    assert max(r["label_id"] for r in rows) < 50


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.text("ab-9", min_size=1, max_size=13), max_size=5).map(" ".join), max_size=5))
def test_pieces_of_a_batch(texts):
    """Cut for all texts at once, also out of the middle of an array."""
    held = pa.array(["left out", *texts, "not this"], pa.string()).slice(1, len(texts))
    last, token, code, size, later, special = cut_pieces(held)
    wanted = [[t for t, _, _ in found] for found in rule_predictor()(texts)]
    assert token.to_pylist() == [t for found in wanted for t in found]
    assert [*last] == [sum(map(len, wanted[: i + 1])) for i in range(len(texts))]
    plain = [t.replace("##", "") for t, s in zip(token.to_pylist(), special) if not s]
    assert [*size[~special]] == [len(t) for t in plain] and [*code[~special]] == [ord(t[0]) for t in plain]
    assert [*later] == [t.startswith("##") for t in token.to_pylist()]


def test_predictions_follow_the_rule(spark, tmp_path):
    texts = ["Alpha betagamma c-9 deltaepsilon zz", None, "one two three four five six"]
    spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, source string").write.parquet(
        str(tmp_path / "documents.parquet")
    )
    got = {r["sample_id"]: r for r in predictions(spark, str(tmp_path)).collect()}
    assert sorted(got) == [0, 2]
    for i, row in got.items():
        found = rule_predictor()([texts[i].lower()])[0]
        assert row["gold"] == [-100 if t in lab.SPECIAL_TOKENS else label for t, label, _ in found]
        assert len(row["pred_a"]) == len(row["pred_b"]) == len(found) and row["pred_a"][0] == row["pred_b"][-1] == 0
    plan = predictions(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    # Pieces are cut per batch, not by functions evaluated piece after piece.
    assert "MapInArrow" in plan and "lambda" not in plan
