import random
import re

import numpy as np
from hypothesis import given, settings, strategies as st
from pyspark.sql import types as T

from corpuslab.llm import op09_decontamination as op9
from corpuslab.llm.wordhash import Lookup, Powers, words_of

from .helpers import ODD, docs_of, rows

SF = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.1"
ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("share", T.StringType())])


def items_of(spark, pairs):
    return spark.createDataFrame([(i, t, "x") for i, t in pairs], ITEMS)


def split(text):
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)


def lcs(a, b):
    best = [0] * (len(b) + 1)
    for x in a:
        row = [0]
        for j, y in enumerate(b):
            row.append(best[j] + 1 if x == y else max(best[j + 1], row[j]))
        best = row
    return best[-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=12), st.lists(st.integers(0, 4), max_size=15))
def test_common_length(a, b):
    words = np.array(a, np.uint64)
    assert op9.common_length(op9.masks_of(words), len(a), b) == lcs(a, b)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("aB1é. \n-_"), max_size=12), min_size=1, max_size=4))
def test_words_of_a_batch(texts):
    words = words_of(texts, Powers())
    every = [w.encode() for t in texts for w in split(t)]
    assert [words.text(i) for i in range(len(words.hash))] == every
    assert np.diff(words.first).tolist() == [len(split(t)) for t in texts]
    by_word = {}
    for w, h in zip(every, words.hash.tolist()):
        assert by_word.setdefault(w, h) == h
    assert len(set(by_word.values())) == len(by_word)
    known = np.unique(words.hash)[::2]
    found = Lookup(known, len(known))(words.hash)
    assert [h in set(known.tolist()) for h in words.hash.tolist()] == (found < len(known)).tolist()
    assert all(known[f] == h for f, h in zip(found.tolist(), words.hash) if f < len(known))


def prose(rng, n, letters="abcdefgh"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 6))) for _ in range(n))


def sentences(rng, n):
    return ". ".join(prose(rng, max(4, n // 3)) for _ in range(3)) + "."


def edited(rng, text, share):
    words = [w for w in text.split() if rng.random() > share]
    return " ".join(x for w in words for x in ([w, prose(rng, 1)] if rng.random() < share else [w]))


def world(seed=1):
    rng = random.Random(seed)
    items = [(100 + i, sentences(rng, rng.randint(15, 90))) for i in range(40)]
    docs, planted = [], {}
    for i in range(120):
        text = prose(rng, rng.randint(20, 400))
        kind = i % 4
        if kind in (1, 2):
            item, passage = rng.choice(items)
            if kind == 2:
                passage = edited(rng, passage, 0.08)
            cut = rng.randint(0, len(text))
            text = text[:cut].rsplit(" ", 1)[0] + "\n" + passage.upper() + "%%% " + text[cut:]
            planted[i] = item
        docs.append((i, text))
    return items, docs, planted


def brute(items, docs):
    """Best share over windows of every beginning, and whether the answer is there."""
    out = {}
    for doc_id, text in docs:
        words = split(text)
        for item_id, item in items:
            wanted, answer = split(item), split(op9.answer_of(item))
            if len(wanted) < op9.MIN_WORDS:
                continue
            width = int(1.2 * len(wanted))
            if len(set(wanted) & set(words)) < op9.PARAPHRASE * len(set(wanted)) / 2:
                continue
            for at in range(0, max(1, len(words) - width + 1), 2):
                inside = words[at : at + width]
                share = lcs(wanted, inside) / len(wanted)
                if share >= op9.COPY or share >= op9.PARAPHRASE and lcs(answer, inside) >= op9.ANSWER * len(answer):
                    out[doc_id, item_id] = max(share, out.get((doc_id, item_id), 0))
    return out


def test_recall_against_brute_force(spark):
    items, docs, planted = world()
    got = {(r["doc_id"], r["item_id"]): r["share"] for r in rows(op9.findings(docs_of(spark, docs, clashing=True), items_of(spark, items)))}
    want = brute(items, docs)
    assert len(want) > 30
    assert len(got.keys() & want.keys()) >= 0.9 * len(want)
    # Every exact passage is found, and nothing in a document without one.
    assert all((d, i) in got and got[d, i] == 1 for d, i in planted.items() if d % 4 == 1)
    assert {d for d, _ in got} <= planted.keys()
    assert all(share >= op9.REWORDED for share in got.values())
    kept = op9.without_leaks(docs_of(spark, docs), items_of(spark, items))
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in docs} - {d for d, _ in got}


def test_blocks_of_items(spark, monkeypatch):
    items, docs, planted = world(2)
    benchmark = items_of(spark, items)
    assert sorted(i for b in op9.blocks_of(benchmark, 7) for i in b.ids) == sorted(i for i, _ in items)
    monkeypatch.setattr(op9.blocks_of, "__defaults__", (15,))
    got = {(r["doc_id"], r["item_id"]) for r in rows(op9.findings(docs_of(spark, docs), benchmark))}
    assert all((d, i) in got for d, i in planted.items() if d % 4 == 1)


def test_odd_rows(spark):
    items = [(1, "same same"), (2, None), (3, ""), (4, "one two three four five six"), (4, "one two three four five six"), (None, "x y z u v w t")]
    docs = [*ODD, (80, "One, two three; four five SIX"), (80, "one two three four five six"), (81, "x y z u v w t " * 50)]
    found = rows(op9.findings(docs_of(spark, docs), items_of(spark, items)))
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(80, 4), (81, None), (11, 1), (12, 1)}
    kept = op9.without_leaks(docs_of(spark, docs, clashing=True), items_of(spark, items))
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(d) for d, _ in ODD if d not in (11, 12))
    empty = docs_of(spark, [])
    assert op9.findings(empty, items_of(spark, items)).count() == 0
    assert op9.findings(docs_of(spark, docs), items_of(spark, [])).count() == 0
    assert op9.without_leaks(docs_of(spark, docs), items_of(spark, [])).count() == len(docs)


def test_directions_are_singular_vectors(spark):
    rng = np.random.default_rng(3)
    dense = rng.standard_normal((60, 12)) * np.linspace(3, 0.2, 12)
    matrix = spark.createDataFrame([(list(range(12)), row.tolist()) for row in dense], "term array<int>, weight array<double>").repartition(3)
    found = op9.term_directions(matrix, 12, 4)
    exact = np.linalg.svd(dense)[2][:4].T
    assert np.allclose(np.abs((found * exact).sum(axis=0)), 1, atol=1e-3)


def test_products_with_frequent_and_other_terms(spark, monkeypatch):
    """Frequent terms as a matrix, the others weight by weight, empty rows: one product."""
    rng = np.random.default_rng(6)
    dense = rng.random((80, 30)) * (rng.random((80, 30)) < np.linspace(0.9, 0.02, 30))
    dense[::9] = 0
    held = [([int(t) for t in np.flatnonzero(r)], [float(x) for x in r[r > 0]]) for r in dense]
    matrix = spark.createDataFrame(held, "term array<int>, weight array<float>").repartition(3)
    basis = rng.standard_normal((30, 4))
    for often in (0, 1, 7, 30, 512):
        monkeypatch.setattr(op9, "OFTEN", often)
        assert np.allclose(op9.product(matrix, basis), dense.T @ (dense @ basis), atol=1e-4)


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = {(r["doc_id"], r["item_id"]) for r in rows(op9.op9_decontamination(spark, SF))}
    exact = {(d, i) for d, t in docs for i, x in items if " ".join(split(x)) in " ".join(split(t))}
    assert exact <= got
    assert len(got) <= len(exact) + 2


def test_many_items_of_document_words(spark):
    """Verbatim items are found whatever their length, and edited ones as brute
    force finds them, with 2,000 items of the words that documents have."""
    rng = random.Random(5)
    own = [r.text for r in spark.read.parquet(f"{LARGER}/documents.parquet").orderBy("doc_id").limit(600).collect()]
    words = [w for r in spark.read.parquet(f"{LARGER}/benchmark.parquet").orderBy("item_id").collect() for w in split(r.text)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(15, 60)))) for i in range(2000)]
    docs, copies, others = [], set(), set()
    for i, text in enumerate(own):
        item, passage = rng.choice(items)
        if i % 2:
            # Three of ten words go, but none of the answer's.
            *head, answer = passage.rpartition(op9.answer_of(passage))[:2]
            kept = [w for w in head[0].split() if rng.random() > 0.3]
            passage = " ".join([*kept, answer])
        (others if i % 2 else copies).add((i, item))
        around = (text or "").split()
        cut = rng.randint(0, len(around))
        docs.append((i, " ".join([*around[:cut], passage, *around[cut:]])))
    got = {(r["doc_id"], r["item_id"]) for r in rows(op9.findings(docs_of(spark, docs), items_of(spark, items)))}
    assert copies <= got
    texts, wanted = dict(docs), dict(items)
    others = {(d, i) for d, i in others if brute([(i, wanted[i])], [(d, texts[d])])}
    assert len(others) > 200 and others <= got


def reworded(rng, item):
    """The item's clauses in another order, one word in ten another one, and the answer last."""
    answer = op9.answer_of(item)
    head = item[: item.rindex(answer)].split()
    head = [prose(rng, 1, "uvwxyz") if rng.random() < 0.1 else w for w in head]
    cuts = [head[i * len(head) // 5 : (i + 1) * len(head) // 5] for i in range(5)]
    return " ".join([*(" ".join(c) for c in reversed(cuts)), answer])


def test_reworded_items_are_found_by_the_directions_alone(spark, monkeypatch):
    """Items told in another order share too few words in a row for the other
    path: with the directions at zero none of them is found, while copies are."""
    rng = random.Random(8)
    items = [(i, sentences(rng, rng.randint(40, 90))) for i in range(40)]
    docs = []
    for i in range(160):
        around = prose(rng, rng.randint(100, 300)).split()
        cut = rng.randint(0, len(around))
        item = items[i % 40][1]
        passage = {0: reworded(rng, item), 1: item, 2: "", 3: ""}[i // 40]
        docs.append((i, " ".join([*around[:cut], passage, *around[cut:]])))
    found = lambda: {(r["doc_id"], r["item_id"]) for r in rows(op9.findings(docs_of(spark, docs), items_of(spark, items)))}
    got = found()
    assert sum((i, i) in got for i in range(40)) >= 36
    assert all((40 + i, i) in got for i in range(40))
    assert {d for d, _ in got} <= set(range(80))
    monkeypatch.setattr(op9, "term_directions", lambda matrix, size, rank=1: np.zeros((size, 1)))
    without = found()
    assert all((40 + i, i) in without for i in range(40))
    lost = sum((i, i) in got and (i, i) not in without for i in range(40))
    assert lost >= 30 and without <= got


def test_short_items_are_exact_sequences(spark):
    items = [(1, "alpha beta"), (2, "Gamma"), (3, "alpha beta gamma delta"), (4, "beta beta"), (5, "one long item of some seven words")]
    docs = [(1, "x ALPHA, beta!"), (2, "alpha x beta"), (3, "a gamma"), (4, "alpha beta gamma"), (5, "delta alpha beta gamma delta"), (6, "beta"), (7, "beta beta beta")]
    got = sorted((r["doc_id"], r["item_id"], r["first_word"]) for r in rows(op9.findings(docs_of(spark, docs), items_of(spark, items))))
    assert got == [(1, 1, 1), (3, 2, 1), (4, 1, 0), (4, 2, 2), (5, 1, 1), (5, 2, 3), (5, 3, 1), (7, 4, 0)]
    only = rows(op9.findings(docs_of(spark, docs), items_of(spark, items[:1])))
    assert {r["doc_id"] for r in only} == {1, 4, 5}


def test_directions_come_from_all_passages_of_all_documents(spark):
    words = [f"w{i}" for i in range(12)]
    items = op9.items_of([{"item_id": 1, "text": " ".join(words[:8])}, {"item_id": 2, "text": " ".join(words[4:])}])
    docs = [(i, " ".join(words[(i + j) % 12] for j in range(130))) for i in range(300)]
    found = op9.passages(docs_of(spark, docs), items, np.ones(len(items.terms)), len(docs)).collect()
    assert len(found) == 300 * 3 + 2
    lengths = sorted(sum(w * w for w in r["weight"]) for r in found)
    # Items of length one, passages that together weigh as much.
    assert np.allclose(lengths[-2:], 1) and np.isclose(sum(lengths[:-2]), 2, atol=1e-4)
