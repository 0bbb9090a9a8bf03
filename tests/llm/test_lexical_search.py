import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from corpuslab.llm import op12_lexical_search as op12

from .helpers import ODD, docs_of

ITEMS = [
    (1, "same same x you"),
    (2, "don't NAÏVE 你好世界"),
    (2, "don't NAÏVE 你好世界"),
    (3, None),
    (4, ""),
    (5, "nowhere"),
    (None, "id minus"),
    (6, "a b c d the the the"),
]


def terms(text):
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", folded)


def plain(docs, items, best=10):
    """Every document scored for every item."""
    counted = [(i, Counter(terms(t))) for i, t in docs]
    n = sum(1 for _, c in counted if c)
    total = sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item_id, text in items:
        scores = []
        for doc_id, c in counted:
            m = 25 + (75 * sum(c.values()) * n) // total if total else 0
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t in terms(text)
                if c[t]
            )
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, r, s[3], -s[0]) for r, s in enumerate(sorted(scores)[:best], 1)]
    return sorted(out, key=str)


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id bigint, text string").selectExpr("*", "1 AS rank", "2 AS item")


def got(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, df.collect()), key=str)


def words_of(seed, n, spread):
    rng = random.Random(seed)
    return " ".join(f"w{int(rng.paretovariate(0.7)) % spread}" for _ in range(n))


def test_odd_rows(spark):
    docs = [*ODD, (20, "don't don't the A, the a b"), (21, "the b"), (22, "c"), (23, "d d d")]
    assert got(op12.search(docs_of(spark, docs, clashing=True), items_of(spark, ITEMS))) == plain(docs, ITEMS)
    assert op12.search(docs_of(spark, []), items_of(spark, ITEMS)).count() == 0
    assert op12.search(docs_of(spark, docs), items_of(spark, [])).count() == 0
    assert op12.search(docs_of(spark, [(1, None), (2, " . ")]), items_of(spark, ITEMS)).count() == 0


def test_ties_copies_and_blocks(spark, monkeypatch):
    """Many equal scores, a hot text, long texts, small blocks of documents and items."""
    docs = [(i, words_of(i, 5 + i % 60, 300)) for i in range(400)]
    docs += [(1_000 + i, "w1 w2 w5 hot") for i in range(300)] + [(5_000, words_of(1, 30_000, 2_000))]
    items = [(i, words_of(-i, 1 + i % 30, 250)) for i in range(1, 40)] + [(50, "w2 hot"), (51, "w1 " * 500)]
    wanted = plain(docs, items)
    assert got(op12.search(docs_of(spark, docs), items_of(spark, items))) == wanted
    monkeypatch.setattr(op12, "BLOCK_ITEMS", 9)
    monkeypatch.setattr(op12, "SLICE_CHARS", 100)
    monkeypatch.setattr(op12, "BLOCK_POSTINGS", 50)
    assert got(op12.search(docs_of(spark, docs).repartition(5), items_of(spark, items))) == wanted
    assert got(op12.search(docs_of(spark, docs), items_of(spark, items), best=3)) == plain(docs, items, 3)


@pytest.mark.parametrize("seed", range(30))
def test_accumulators_are_limited_and_exact(seed):
    """Documents without an accumulator score less than the k-th best; others have their exact score."""
    rng = np.random.default_rng(seed)
    size, vocabulary, best = 300, 40, 5
    share = rng.random(vocabulary) ** 3
    held = rng.random((size, vocabulary)) < share
    counts = np.where(held, rng.integers(1, 6, held.shape), 0)
    holding = held.sum(axis=0)
    weights = np.array([op12.weight(size, int(h)) for h in holding], np.int64)
    lengths = counts.sum(axis=1)
    doc, term = np.nonzero(held)
    block = op12.Postings(lengths, held.sum(axis=1), term, counts[doc, term], weights, size, int(lengths.sum()))
    plan = [(int(t), int(rng.integers(1, 3))) for t in np.argsort(holding, kind="stable") if holding[t]]
    norm = 25 + (75 * lengths * size) // int(lengths.sum())
    gains = weights * ((10**9 * counts) // np.maximum(1, 1000 * counts + 8 * norm[:, None]))
    exact = sum(r * gains[:, t] for t, r in plan)
    least = np.sort(exact)[-best]
    for known in (0, int(least)):
        places, scores = op12.search_block(block, size, plan, best, known)
        assert (scores == exact[places]).all()
        assert set(np.flatnonzero(exact >= least)) <= set(places.tolist())
    # A score that few reach leaves few accumulators.
    few, _ = op12.search_block(block, size, plan, best, int(exact.max()))
    assert len(few) <= len(places)


def test_unreachable_scores_create_nothing():
    block = op12.Postings(np.full(4, 10), np.full(4, 1), np.zeros(4, int), np.ones(4, int), np.array([100]), 4, 40)
    places, _ = op12.search_block(block, 4, [(0, 1)], 2, int(block.most[0]) + 1)
    assert not len(places)
    places, _ = op12.search_block(block, 4, [(0, 1)], 2, int(block.most[0]))
    assert len(places) == 4
