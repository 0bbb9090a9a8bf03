import gzip
import math
from collections import Counter
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from corpuslab.operators import cleaning, corpusstats, features as feats
from corpuslab.session import scratch_path, via_table
from corpuslab.sources import corpus, files, sinks

NOTES = [
    ("Patient with diabetes was given metformin twice daily for diabetes.", 5),
    ("The patient reports chest pain; an aspirin was given at once.", 4),
    ("Follow up in two weeks, blood pressure was high and remains high.", 4),
    ("No change in the weight of the patient since the last visit here.", -1),
]


@pytest.fixture(scope="module")
def notes(spark):
    rows = [(f"d{i:03d}", *NOTES[i % 4], "note") for i in range(40)]
    return spark.createDataFrame(rows, "doc_id string, text string, rating int, source string")


@pytest.fixture(scope="module")
def tokens(notes):
    return feats.token_columns(cleaning.clean_text(notes))


def test_layouts(spark, notes):
    review = notes.toDF("review_id", "review_body", "star_rating", "product_title")
    assert sorted(corpus.normalize_schema(review).collect()) == sorted(notes.select("doc_id", "text", "rating", "source").collect())
    content = corpus.normalize_schema(notes.drop("doc_id").toDF("content", "label", "title"))
    assert content.columns == ["doc_id", "text", "rating", "source"]
    assert content.select("doc_id").distinct().count() == 4
    with pytest.raises(ValueError, match="unknown corpus layout"):
        corpus.normalize_schema(notes.select("doc_id", "rating"))


def test_expansion(notes):
    got = {r.doc_id: r.text for r in corpus.expand_corpus(notes.limit(1), 4).collect()}
    text = NOTES[0][0]
    assert got == {
        "d000_v000": text + corpus.APPENDED,
        "d000_v001": corpus.PREFIXED + text,
        "d000_v002": text,
        "d000_v003": text + corpus.APPENDED,
    }


def test_hashed_sample_ignores_partitioning(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("doc_id"))
    a = {r.doc_id for r in corpus.sample_docs(df.repartition(2), 0.2, by="doc_id").collect()}
    b = {r.doc_id for r in corpus.sample_docs(df.repartition(7), 0.2, by="doc_id").collect()}
    assert a == b and 800 < len(a) < 1200
    assert 700 < corpus.sample_docs(df, 0.2).count() < 1300


def test_spread_leaves_wide_input_alone(spark):
    df = spark.range(0, 100, 1, 6)
    assert corpus.spread(df, 4) is df
    assert corpus.spread(df, 9).rdd.getNumPartitions() == 9


def test_union_ids(spark):
    a = spark.createDataFrame([("1",), ("2",)], "doc_id string")
    b = spark.createDataFrame([("2",), ("3",)], "doc_id string")
    assert sorted(r.doc_id for r in corpus.union_ids([a, b, a]).collect()) == ["1", "2", "3"]


def test_filters_reach_the_scan(spark, notes):
    path = scratch_path(spark, "notes")
    notes.write.partitionBy("rating").parquet(path)
    df = cleaning.clean_text(corpus.read_corpus(spark, path).filter("rating = 5")).select("doc_id", "text_clean")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(text)" in plan and "PartitionFilters: [isnotnull(rating" in plan
    assert "source" not in plan.split("ReadSchema")[1]
    assert df.count() == 10


def test_tfidf(tokens):
    docs = {r.doc_id: r.filtered_words for r in tokens.collect()}
    present = Counter(w for words in docs.values() for w in set(words))
    want = {
        (d, w): (n, n * math.log((len(docs) + 1) / (present[w] + 1)))
        for d, words in docs.items()
        for w, n in Counter(words).items()
    }
    got = {(r.doc_id, r.term): (r.tf, r.tfidf) for r in feats.tfidf(tokens).collect()}
    assert got.keys() == want.keys()
    assert all(got[k][0] == want[k][0] and got[k][1] == pytest.approx(want[k][1]) for k in want)
    top = feats.top_terms(feats.tfidf(tokens), 2).filter("doc_id = 'd000'").orderBy("rank").collect()
    assert [r.term for r in top][0] == "diabetes"


def test_hashed_totals_match_the_words(tokens):
    raw = feats.hashed_features(tokens, "filtered_words", "raw")
    totals = feats.vector_entries(raw, ["doc_id"], "raw").groupBy("doc_id").agg(F.sum("value").alias("n"))
    sizes = {r.doc_id: r.n for r in tokens.select("doc_id", F.size("filtered_words").alias("n")).collect()}
    assert {r.doc_id: r.n for r in totals.collect()} == sizes


def test_feature_table_round_trip(spark, notes):
    cleaned = via_table(cleaning.clean_text(notes), "cleaned")
    vectors, model = feats.extract_features(cleaned)
    path = scratch_path(spark, "features")
    sinks.write_features(vectors, path)
    back = spark.read.parquet(path)
    assert sorted(back.columns) == sorted(sinks.FEATURE_COLUMNS) and back.count() == 40
    idf = model.stages[4]
    assert idf.numDocs == 40
    index = feats.vector_entries(vectors.filter("doc_id = 'd000'"), ["doc_id"], "raw_features").first()["index"]
    assert idf.idf[index] == pytest.approx(math.log(41 / (idf.docFreq[index] + 1)))
    plan = back.filter("rating = 5")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(rating" in plan
    stats = corpusstats.corpus_statistics(back)
    sinks.write_stats(stats, path + "-stats")
    written = spark.read.schema(stats.schema).json(path + "-stats").first()
    assert written == stats.first()


def test_statistics_document(tokens):
    row = corpusstats.corpus_statistics(tokens).first()
    rows = tokens.collect()
    sizes = [r.word_count for r in rows]
    words = Counter(w for r in rows for w in r.filtered_words)
    assert (row.total_documents, row.total_words) == (40, sum(sizes))
    assert row.avg_document_length == round(np.mean(sizes), 1)
    assert row.std_document_length == round(np.std(sizes, ddof=1), 1)
    assert row.median_document_length == sorted(sizes)[19]
    want = sorted(words.items(), key=lambda x: (-x[1], x[0]))[:20]
    assert [(w.word, w["count"]) for w in row.top_20_words] == want
    assert row.rating_distribution == {"-1": 10, "4": 20, "5": 10}


def test_validation_finds_every_rule(spark, tokens):
    bad = tokens.limit(3).unionByName(tokens.filter("doc_id = 'd000'"))
    bad = bad.unionByName(tokens.filter("doc_id = 'd005'").withColumns(
        {"doc_id": F.lit(None).cast("string"), "word_count": F.lit(3), "filtered_words": F.array().cast("array<string>")}
    ))
    got = {r.rule: (r.checked, r.violations, r.passed) for r in sinks.validate_output(bad, ["doc_id"], sinks.feature_rules(bad)).collect()}
    assert got["doc_id_present"] == (5, 1, False) and got["word_count_in_range"] == (5, 1, False)
    assert got["filtered_words_not_empty"] == (5, 1, False) and got["text_present"] == (5, 0, True)
    assert got["doc_id_unique"][1] == 1 and got["schema"] == (5, 0, True)
    missing = sinks.validate_output(tokens.drop("rating"), ["doc_id", "rating"], {}).collect()
    assert [(r.rule, r.violations, r.passed) for r in missing] == [("schema", 1, False)]


def test_histogram(spark):
    values = [0.0, 0.1, 0.5, 0.99, 1.0, 1.0, 0.3]
    df = spark.createDataFrame([("a", v) for v in values] + [("b", 2.0), ("b", None)], "g string, x double")
    got = {(r.g, r.bin): r.n for r in corpusstats.histogram(df, ["g"], "x", 10).collect()}
    want = {("a", i): int(n) for i, n in enumerate(np.histogram(values, 10)[0])}
    assert got == {**want, ("b", 0): 1}
    whole = corpusstats.histogram(df.filter("g = 'a'").drop("g"), [], "x", 10).collect()
    assert {r.bin: r.n for r in whole} == {b: n for (_, b), n in want.items()}


@pytest.mark.parametrize("group_rows", [25, 100_000])
def test_rolling_mean(spark, group_rows):
    values = [round(math.sin(i) * 50 + i / 7, 3) for i in range(240)]
    df = spark.createDataFrame(list(enumerate(values)), "i int, x double")
    got = {r.i: r.x_rolling for r in corpusstats.rolling_mean(df, "i", ["x"], group_rows=group_rows).collect()}
    want = pd.Series(values).rolling(12).mean()
    for i in range(240):
        assert got[i] is None if i < 11 else got[i] == pytest.approx(want[i])


def test_run_metrics(notes):
    row = corpusstats.run_metrics(cleaning.clean_text(notes)).first()
    assert row.input_records == 40 and row.total_runtime_seconds > 0


def test_text_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("  Metformin 500 mg.\nTwice daily.  \n")
    (tmp_path / "b.txt").write_text(" \n ")
    got = {r.path.rsplit("/", 1)[1]: (r.text, r.error) for r in files.read_text_files(spark, str(tmp_path)).collect()}
    assert got == {"a.txt": ("Metformin 500 mg.\nTwice daily.", None), "b.txt": (None, "File is empty")}


def test_reports(spark, tmp_path):
    (tmp_path / "d.json").write_text('{"teacher": {"macro_f1": 0.8, "model": "x"}, "summary": {"speedup": 1.9}, "total": 3}')
    (tmp_path / "o.json").write_text('{"results": {"int8": {"macro_f1": 0.7}}, "summary": {"target_met": {"3x": true}}}')
    paths = {"distillation": f"{tmp_path}/d.json", "optimization": f"{tmp_path}/o.json", "corpus": f"{tmp_path}/none.json"}
    got = {(r.component, r.variant, r.metric): r.value for r in files.read_reports(spark, paths).collect()}
    assert got == {
        ("distillation", "teacher", "macro_f1"): 0.8,
        ("distillation", "summary", "speedup"): 1.9,
        ("distillation", "", "total"): 3.0,
        ("optimization", "int8", "macro_f1"): 0.7,
    }
    with pytest.raises(FileNotFoundError):
        files.read_reports(spark, {"corpus": f"{tmp_path}/none.json"})


def test_load_test_file(spark, tmp_path):
    (tmp_path / "r.json").write_text(
        '[{"request_id": "a", "latency_ms": 5.5, "num_entities": 2, "num_tokens": 9, "status": "success"},'
        ' {"request_id": "b", "latency_ms": 0, "num_entities": 0, "num_tokens": 0, "status": "error", "error": "boom"}]'
    )
    got = sorted((r.request_id, r.latency_ms, r.error) for r in files.read_load_test(spark, str(tmp_path)).collect())
    assert got == [("a", 5.5, None), ("b", 0.0, "boom")]


def test_text_files_stand_in_few_folders(spark, tmp_path):
    from corpuslab.catalog import corpus as queries
    from corpuslab.session import scratch_tables, shared_folder

    rows = [(i, None if i % 50 == 0 else f" text {i}\n" if i % 7 else "", "s") for i in range(1500)] + [(None, "none", "s")]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    before = set(Path(shared_folder(spark)).glob("text-files-*"))
    with scratch_tables():
        got = {r.doc_id: (r.text, r.error) for r in queries.s04(spark, str(tmp_path)).collect()}
        written = set(Path(shared_folder(spark)).glob("text-files-*")) - before
        folders = [p for w in written for p in w.rglob("*") if p.is_dir()]
    want = {"__HIVE_DEFAULT_PARTITION__" if i is None else str(i): (text or "").strip() for i, text, _ in rows}
    assert got == {i: (text or None, None if text else files.EMPTY_FILE) for i, text in want.items()}
    assert len(folders) < 50


def test_packed_and_hidden_files(spark, tmp_path):
    (tmp_path / "a=1").mkdir()
    (tmp_path / "a=1" / "x.txt.gz").write_bytes(gzip.compress(b" packed "))
    (tmp_path / "a=1" / "y.txt").write_bytes(b"plain")
    (tmp_path / "a=1" / "none.gz").write_bytes(b"")
    for name in ("_SUCCESS", ".part.crc"):
        (tmp_path / name).write_bytes(b"hidden")
    (tmp_path / "_k=2").write_bytes(b"kept")
    got = {r.path.rsplit("/", 1)[1]: (r.text, r.error) for r in files.read_text_files(spark, str(tmp_path)).collect()}
    assert got == {"x.txt.gz": ("packed", None), "y.txt": ("plain", None), "none.gz": (None, files.EMPTY_FILE), "_k=2": ("kept", None)}


def test_texts_are_cleaned_once_for_the_recount(spark, tmp_path, monkeypatch):
    from corpuslab.catalog import corpus as queries, tables

    rows = [(i, f"Plain words with number {i % 7} and {'more ' * (i % 5)}of it all the time", "s") for i in range(60)]
    rows += [(60, None, "s"), (61, "the and of it is", "s"), (3, "once more the words of another text", "s")]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    calls, features = [], tables.features
    monkeypatch.setattr(tables, "features", lambda *a, **k: calls.append(1) or features(*a, **k))
    for query in (queries.x05_off, queries.x07_off):
        calls.clear()
        got = query(spark, str(tmp_path)).filter("doc_id <> '3'").collect()
        assert len(got) >= 59 and all(r.off == 0 for r in got)
        assert len(calls) == 1
