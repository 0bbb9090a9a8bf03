"""One dictionary over a corpus, mergeable quantiles, chains of better epochs,
models that stay in their worker, and replacement that survives a lost job."""

import os
import random
import re
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from corpuslab.catalog import labelling, tables
from corpuslab.operators import dictionary as dic, evaluate as ev, labelling as lab, sketches as sk
from corpuslab.sources import files, sinks


def plain_matches(text, entries):
    """Leftmost, then longest, by trying every entry at every place."""
    lowered, out, at = dic.folded(text or ""), [], 0
    while at < len(lowered):
        fit = max((e for e in entries if lowered.startswith(e, at)), key=len, default=None)
        if fit:
            out.append((at, at + len(fit), entries[fit]))
            at += len(fit)
        else:
            at += 1
    return out


def entity_rows(rng, n):
    return [(rng.choice(["Chemical", "Disease"]), "".join(rng.choices("abAB é.(", k=rng.randint(1, 5))), round(rng.random(), 2)) for _ in range(n)]


@pytest.mark.parametrize("part_chars", [20, 10_000])
def test_dictionary_against_brute_force(spark, part_chars):
    rng = random.Random(part_chars)
    entities = entity_rows(rng, 40) + [("Disease", "", 0.5), ("Disease", None, 0.5), ("Chemical", "İx", 0.1)]
    texts = ["".join(rng.choices("abABcé.(< İx", k=rng.randint(0, 60))) for _ in range(60)] + [None, "", "a" * 5_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = spark.createDataFrame(entities, "label string, text string, confidence double")
    best = {}
    for label, text, confidence in entities:
        if text:
            key = dic.folded(text.lower())
            best[key] = min(best.get(key, (1, "z")), (-confidence, label))
    entries = {k: v[1] for k, v in best.items()}
    got = {r.doc_id: [tuple(m) for m in r.matches] for r in dic.dictionary_matches(docs, found, part_chars=part_chars).collect()}
    assert got == {i: plain_matches(t, entries) for i, t in enumerate(texts)}
    none = dic.dictionary_matches(docs, found.limit(0)).collect()
    assert len(none) == len(texts) and not any(r.matches for r in none)


def test_corpus_annotation(spark):
    docs = spark.createDataFrame([(1, "Aspirin & aspirin-like <b>"), (2, None), (3, "ASPIRIN-LIKE")], "doc_id long, text string")
    entities = spark.createDataFrame([("Chemical", "aspirin"), ("Disease", "Aspirin-like")], "label string, text string")
    got = {r.doc_id: r.annotated for r in dic.annotate_corpus(docs, entities).collect()}

    def tag(label, text):
        return f'<span class="entity entity-{label}" title="{label}">{text}</span>'

    assert got == {1: f"{tag('Chemical', 'Aspirin')} &amp; {tag('Disease', 'aspirin-like')} &lt;b&gt;", 2: None, 3: tag("Disease", "ASPIRIN-LIKE")}


def test_query_looks_for_every_entity_text(spark, tmp_path):
    """Entity texts count whatever they begin with: letters of either half of the alphabet, digits, hyphens."""
    rng = random.Random(5)
    words = ["".join(rng.choices("abdeijmnoprstuvwxyz019-", k=rng.randint(1, 9))) for _ in range(80)]
    docs = [(i, " ".join(rng.choices(words, k=rng.randint(5, 40))), "s") for i in range(40)] + [(40, None, "s"), (41, "few", "s"), (7, "zz oo nn yy tt uu", None)]
    spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(2).write.parquet(f"{tmp_path}/documents.parquet")
    best = {}
    for e in labelling.n11(spark, str(tmp_path)).collect():
        if e.text:
            best[e.text] = min(best.get(e.text, (1, "z")), (-e.confidence, e.label))
    entries = {text: label for text, (_, label) in best.items()}
    assert {bool("a" <= text[0] <= "m") for text in entries} == {True, False}
    want = {}
    for doc in tables.cleaned(spark, str(tmp_path)).collect():
        found = plain_matches(doc.text_clean, entries)
        if found:
            old = want.get(doc.doc_id, (0, 0, 0))
            new = (len(found), sum(label == "Chemical" for _, _, label in found), sum(e - s for s, e, _ in found))
            want[doc.doc_id] = tuple(a + b for a, b in zip(old, new, strict=True))
    got = {r.doc_id: (r.matches, r.chemicals, r.covered) for r in labelling.p14_corpus(spark, str(tmp_path)).collect()}
    assert got == want and len(want) > 30


def test_large_dictionary_is_linear_in_the_text():
    rows = [(f"entry {i * 7919 % 1_000_003} of many", "x") for i in range(100_000)]
    machine = dic.automaton_of("large", rows)
    assert dic.automaton_of("large", rows) is machine
    text = " and ".join(r[0] for r in rows[:20_000])
    seconds = []
    for size in (1, 4):
        started = time.perf_counter()
        found = dic.leftmost([(s, e, label) for s, (e, label) in dic.longest_at(machine, text * size).items()])
        seconds.append(time.perf_counter() - started)
        assert len(found) == 20_000 * size
    assert seconds[1] < 10 * seconds[0] + 1


def test_merged_sketches(spark):
    rng = random.Random(4)
    values = [(i % 50, "hot" if i % 3 else "cold", rng.expovariate(0.01)) for i in range(60_000)] + [(1, "hot", None), (1, "none", None)]
    df = spark.createDataFrame(values, "minute int, k string, v double").repartition(4)
    stored = sk.sketched(df, ["minute", "k"], "v")
    merged = {r.k: r for r in sk.sketch_quantiles(sk.merged(stored, ["k"])).collect()}
    direct = {r.k: r for r in sk.sketch_quantiles(sk.sketched(df, ["k"], "v")).collect()}
    assert set(merged) == set(direct) == {"hot", "cold"}
    for key in merged:
        own = sorted(v for _, k, v in values if k == key and v is not None)
        assert merged[key]["count"] == direct[key]["count"] == len(own)
        for found in (merged[key], direct[key]):
            for name, q in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99)):
                rank = sum(v <= found[name] for v in own) / len(own)
                assert abs(rank - q) <= 3 * sk.rank_error()
    assert sk.rank_error(200) == pytest.approx(0.0133, abs=2e-4)


def fold(values, delta, patience):
    best, at, wait, n = 0.0, None, 0, 0
    for n, v in enumerate(values, 1):
        if v is not None and v > best + delta:
            best, at, wait = v, n, 0
        else:
            wait += 1
        if patience is not None and wait >= patience:
            return at, best, n, True
    return at, best, n, False


@pytest.mark.parametrize(("delta", "patience"), [(0.001, 3), (0.05, 2), (0.0, None), (0.3, 5)])
def test_chains_of_better_epochs(spark, delta, patience):
    rng = random.Random(int(delta * 1000))
    runs = {i: [rng.choice([None, round(rng.random() * (j + 1) / 30, 2)]) for j in range(rng.randint(1, 40))] for i in range(40)}
    runs[None] = [0.1, 0.2, 0.1, 0.1, 0.1, 0.9]
    rows = [(i, e, v) for i, vs in runs.items() for e, v in enumerate(vs, 1)]
    df = spark.createDataFrame(rows, "run int, epoch int, val_macro_f1 double").repartition(3)
    got = {r.run: tuple(r[1:]) for r in ev.select_checkpoint(df, ["run"], delta, patience, 50).collect()}
    assert got == {i: fold(vs, delta, patience) for i, vs in runs.items()}


def test_one_long_run(spark):
    """A run in which every epoch is better: the chain is followed in some seventeen rounds."""
    n = 100_000
    df = spark.range(1, n + 1).selectExpr("'r' AS run", "CAST(id AS INT) AS epoch", "id / 50000.0D AS val_macro_f1")
    row = ev.select_checkpoint(df, ["run"], 0.0, 3, 20_000).first()
    assert row[1:] == (n, n / 50_000, n, False)


def test_one_model_per_worker(spark, tmp_path):
    folder = str(tmp_path)

    def factory():
        with open(f"{folder}/{os.getpid()}-{time.time_ns()}", "w"):
            pass

        def predict(texts):
            sizes = [len(t) for t in texts]
            assert sizes == sorted(sizes)
            return [[(w, len(w) % 5, 0.9) for w in t.split()] for t in texts]

        return predict

    rng = random.Random(1)
    texts = [" ".join("w" * rng.randint(1, 9) for _ in range(rng.randint(0, 50))) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(40)
    labelled = lab.predict_tokens(df, factory)
    got = {r.doc_id: [t.token for t in r.tokens] for r in labelled.collect()}
    assert got == {i: t.split() for i, t in enumerate(texts)}
    labelled.count(), labelled.collect()
    loads = [name.split("-")[0] for name in os.listdir(folder)]
    assert len(loads) == len(set(loads)) and len(loads) < 40


def test_agreement_of_spans_in_numbers(spark):
    rng = random.Random(2)
    schema = "array<struct<start:int,end:int,label:string>>"

    def spans(label):
        return [(s := rng.randrange(12), s + rng.randrange(3), label()) for _ in range(rng.randrange(9))]

    known = lambda: rng.choice(["Chemical", "Disease"])
    odd = lambda: rng.choice(["Chemical", "Gene", None])
    rows = [(i, spans(known if i % 2 else odd), spans(known if i % 2 else odd)) for i in range(200)]
    rows += [(-1, [(5, 1 << 30, "Disease")], [(5, 1 << 30, "Disease")]), (-2, [(1 << 30, (1 << 30) + 4, "Chemical")], [(1 << 30, (1 << 30) + 4, "Chemical")])]
    df = spark.createDataFrame(rows, f"doc_id long, spans_a {schema}, spans_b {schema}")
    got = {r.doc_id: (r.entities_a, r.entities_b, r.both) for r in lab.span_agreement(df).collect()}
    assert got == {i: (len(a), len(b), len(set(a) & set(b))) for i, a, b in rows}


def test_files_without_a_listing(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    content = {"a.txt": b"", "b.txt": b" x \n", "deep/c.txt": "é\nß".encode(), "deep/d.txt": b"\xff\xfe bad", "e.txt": b"\n \n"}
    for name, raw in content.items():
        (tmp_path / name).write_bytes(raw)
    frame = files.read_text_files(spark, str(tmp_path))
    got = {re.sub(r".*/", "", r.path): (r.text, r.error) for r in frame.collect()}
    assert got["a.txt"] == got["e.txt"] == (None, files.EMPTY_FILE)
    assert got["b.txt"] == ("x", None) and got["c.txt"] == ("é\nß", None) and got["d.txt"][1] is None
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "LocalTableScan" not in plan
    (tmp_path / "two words").mkdir()
    (tmp_path / "two words" / "no thing.txt").write_bytes(b"")
    (tmp_path / "two words" / "some thing.txt").write_bytes(b"y")
    (tmp_path / "_hidden").write_bytes(b"")
    paths = {r.path for r in files.read_text_files(spark, str(tmp_path)).collect()}
    folder = f"file:{tmp_path}/two%20words"
    assert {f"{folder}/no%20thing.txt", f"{folder}/some%20thing.txt"} <= paths and len(paths) == 7
    assert {r.path for r in files.read_text_files(spark, f"{tmp_path}/*.txt").collect()} == {f"file:{tmp_path}/{n}.txt" for n in "abe"}


def rated(spark, ratings, mark):
    rows = [(f"{mark}{r}{i}", "some text", r, "s", 2, ["some"], None, None) for r in ratings for i in range(5)]
    names = "doc_id string, text_clean string, rating int, source string, word_count int, filtered_words array<string>, tfidf_features string, bigram_tfidf_features string"
    return spark.createDataFrame(rows, names).repartition(4)


def broken(df, column):
    return df.withColumn(column, F.when(F.rand() >= 0, F.raise_error(F.lit("lost"))).otherwise(F.col(column)))


def test_features_survive_a_lost_job(spark, tmp_path):
    path = f"{tmp_path}/features"
    sinks.write_features(rated(spark, [0, 1, 2], "old"), path)
    with pytest.raises(Exception, match="lost"):
        sinks.write_features(broken(rated(spark, [1, 2], "bad"), "doc_id"), path)
    read = lambda: {(r.rating, r.doc_id[:3]) for r in spark.read.parquet(path).collect()}
    assert read() == {(0, "old"), (1, "old"), (2, "old")}
    sinks.write_features(rated(spark, [1, 3], "new"), path)
    assert read() == {(0, "old"), (1, "new"), (2, "old"), (3, "new")}


def test_stats_and_labels_survive_a_lost_job(spark, tmp_path):
    path = f"{tmp_path}/stats"
    stats = spark.createDataFrame([(1, "a")], "n int, s string")
    sinks.write_stats(stats, path)
    with pytest.raises(Exception, match="lost"):
        sinks.write_stats(broken(stats, "s"), path)
    assert spark.read.text(path).first()[0] == '{"n":1,"s":"a"}' and os.listdir(tmp_path) == ["stats"]
    sinks.write_stats(spark.createDataFrame([(2, "b")], "n int, s string"), path)
    assert spark.read.text(path).first()[0] == '{"n":2,"s":"b"}' and os.listdir(tmp_path) == ["stats"]
    # A run that was cut off between the two moves.
    Path(path).rename(f"{path}-former")
    with pytest.raises(Exception, match="lost"):
        sinks.write_stats(broken(stats, "s"), path)
    assert spark.read.text(path).first()[0] == '{"n":2,"s":"b"}'
    labels = spark.createDataFrame([(["a"], ["O"], 1, 0.9)], "tokens array<string>, tags array<string>, doc_id long, avg_confidence double")
    for _ in range(2):
        sinks.write_silver_labels(labels, f"{tmp_path}/labels")
    assert spark.read.json(f"{tmp_path}/labels").count() == 1
