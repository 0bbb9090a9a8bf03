import itertools
import math
import random
import re

import numpy as np

from corpuslab.llm import op06_quality_classifier as op6, wordhash
from corpuslab.llm.common import sampled_texts

from .helpers import ODD, docs_of, rows

SF = "/root/testdata/sf0.01"


def test_estimates_find_the_labellers():
    rng = random.Random(2)
    n = len(op6.LABELLERS)
    right = [0.95, 0.9, 0.8, 0.7, 0.9, 0.85, 0.6, 0.75, 0.8, 0.9]
    counts, truth = {}, {}
    for _ in range(30_000):
        good = rng.random() < 0.8
        votes = ""
        for k in range(n):
            if rng.random() < 0.3:
                votes += "2"
            else:
                votes += str(int(good if rng.random() < right[k] else not good))
        counts[votes] = counts.get(votes, 0) + 1
        truth.setdefault(votes, []).append(good)
    posterior, share, given = op6.estimate(counts, belief=0)
    assert abs(share - 0.8) < 0.03
    for k in range(n):
        assert abs(given[k, 1, 1] / (given[k, 1, 0] + given[k, 1, 1]) - right[k]) < 0.05
    hits = sum((posterior[p] > 0.5) == g for p, own in truth.items() for g in own)
    assert hits > 0.95 * 30_000


def test_estimates_are_the_likelihood_steps():
    """One more step, written out by pattern, changes nothing."""
    counts = {"".join(p): 1 + i % 7 for i, p in enumerate(itertools.product("012", repeat=2))}
    counts = {p + "2" * (len(op6.LABELLERS) - 2): n for p, n in counts.items()}
    posterior, share, given = op6.estimate(counts, rounds=5000, belief=0)
    for p in counts:
        good, bad = share, 1 - share
        for k, v in enumerate(p):
            good *= given[k, 1, int(v)]
            bad *= given[k, 0, int(v)]
        assert abs(posterior[p] - good / (good + bad)) < 1e-3


def test_patterns_are_counted(spark):
    docs = docs_of(spark, ODD, clashing=True)
    want = {}
    for _, text in ODD:
        p = op6.pattern_of(text or "")
        want[p] = want.get(p, 0) + 1
    assert op6.pattern_counts(docs) == want
    assert op6.estimate({})[0] == {}


def mixed(n):
    rng = random.Random(4)
    for i in range(n):
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(120)]
        if i % 5 == 0:
            yield i, " ".join(w + "###" for w in words)
        elif i % 5 == 1:
            yield i, "\n".join([" ".join(words[:6])] * 20)
        else:
            yield i, ". ".join(" ".join(words[k : k + 10]) for k in range(0, 120, 10)) + "."


def test_scores(spark):
    docs = list(mixed(100))
    got = {r["doc_id"]: r for r in rows(op6.quality_scores(docs_of(spark, docs, clashing=True)))}
    assert len(got) == 100 and all(0 <= r["score"] <= 1 for r in got.values())
    assert all(got[i]["kept"] == (i % 5 > 1) for i, _ in docs)


def test_odd_rows(spark):
    got = rows(op6.quality_scores(docs_of(spark, ODD)))
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(d) for d, _ in ODD)
    assert op6.quality_scores(docs_of(spark, [])).count() == 0
    one = rows(op6.quality_scores(docs_of(spark, [(1, "a b")])))
    assert len(one) == 1 and 0 <= one[0]["score"] <= 1


def test_query_on_true_labels(spark):
    """The labels of the table are held out: nothing is trained on them."""
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = {r["doc_id"]: r for r in rows(op6.op6_quality_classifier(spark, SF))}
    known = [(got[d]["score"], q, got[d]["kept"]) for d, q in labels.items() if q is not None]
    good = np.array([s for s, q, _ in known if q == 1])
    bad = np.array([s for s, q, _ in known if q == 0])
    area = (good[:, None] > bad[None, :]).mean() + 0.5 * (good[:, None] == bad[None, :]).mean()
    assert area > 0.9
    assert sum(k for _, q, k in known if q == 1) >= 0.97 * len(good)


def test_defects_after_the_first_thousand_words():
    rng = random.Random(6)
    varied = ["".join(rng.choice("abcdefgh") for _ in range(6)) + "." for _ in range(3000)]
    votes = lambda words: dict(zip(op6.LABELLERS, op6.pattern_of(" ".join(words)), strict=True))
    late = votes([*varied[:1000], *["one", "two", "three."] * 5000])
    assert (late["variety"], late["prose"]) == (str(op6.BAD), str(op6.SILENT))
    early = votes([*["one", "two", "three."] * 100, *varied])
    assert (early["variety"], early["prose"]) == (str(op6.SILENT), str(op6.GOOD))
    # As varied at any length.
    assert votes(varied * 6)["prose"] == votes(varied[:1000])["prose"] == str(op6.GOOD)


def plain_features(text):
    """The scorer's features, word by word with whole numbers."""

    def hashed(word, salt):
        h = sum(b * pow(wordhash.BASE, i, 1 << 64) for i, b in enumerate(word)) % (1 << 64)
        h ^= h >> 32
        h = h * int(wordhash.MIX) % (1 << 64)
        h ^= h >> 29
        return (h ^ salt) % op6.HASHED

    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode()
    words = re.findall(rb"[0-9a-z\x80-\xff]+", folded)
    marks = re.findall(rb"[!-/:-@\[-`{-~]+", (text or "").encode())
    varied = 10 * len(set(words)) // max(1, len(words))
    return {hashed(w, 0) for w in words} | {hashed(m, int(op6.MARK_SALT)) for m in marks} | {op6.HASHED + varied}


def test_scores_against_plain_features(spark):
    """Scores of all rows, recomputed from the model's weights text by text."""
    docs = [*ODD, *mixed(60), (500, "### $$ ok"), (501, "ab" * 50_000 + " # " * 2_000)]
    df = docs_of(spark, docs, clashing=True)
    model = op6.train(df)
    assert np.abs(model.weight).max() > 0
    got = rows(op6.scored(df, model))
    wanted = []
    for doc_id, text in docs:
        margin = model.start + sum(model.weight[f] for f in sorted(plain_features(text)))
        wanted.append((doc_id, 1 / (1 + math.exp(-margin))))
    got = sorted(((r["doc_id"], r["score"]) for r in got), key=str)
    for (a, score), (b, plain) in zip(got, sorted(wanted, key=str), strict=True):
        assert a == b and abs(score - plain) < 2e-6


def test_sample_does_not_depend_on_partitions(spark):
    docs = [*mixed(80), *[(1_000 + i, "one copied text of some words") for i in range(300)]]
    one = op6.train(docs_of(spark, docs).repartition(1), 100)
    many = op6.train(docs_of(spark, docs[::-1]).repartition(7), 100)
    assert (one.weight == many.weight).all() and one.start == many.start
    assert sampled_texts(docs_of(spark, docs), 380).filter("copies = 300").count() == 1


def test_fit_reaches_the_posteriors():
    feature, first = np.array([0, 2, 1, 2, 0, 1]), np.array([0, 2, 4, 6])
    chance = np.array([0.9, 0.1, 0.5])
    model = op6.fitted(feature, first, chance, np.array([1.0, 1.0, 1.0]))
    assert np.abs(model(feature, first) - chance).max() < 0.1
