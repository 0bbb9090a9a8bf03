import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from corpuslab.llm import op11_periodic_runs as op11

from .helpers import ODD, docs_of, rows

SF = "/root/testdata/sf0.001"


def plain_runs(words):
    """Every period's maximal stretches; of one stretch the smallest period."""
    found = {}
    n = len(words)
    for q in range(1, n // 2 + 1):
        same = np.array([words[i] == words[i + q] for i in range(n - q)], bool)
        edges = np.flatnonzero(np.diff(np.concatenate([[0], same.astype(np.int8), [0]])))
        for s, e in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if e - s + q >= max(12, 2 * q):
                found.setdefault((s, e - s + q), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def engine_runs(words, tile_words=op11.TILE_WORDS):
    """The operator's steps without Spark."""
    codes = op11.coded([w.encode() for w in words])
    parts = {}
    old, op11.TILE_WORDS = op11.TILE_WORDS, tile_words
    try:
        for octave, first, some, boundaries in op11.tiles_of(codes):
            for b in boundaries.tolist():
                for p, s, e in op11.fragments(octave, some, b):
                    parts.setdefault(p, []).append((first + s, first + e))
    finally:
        op11.TILE_WORDS = old
    out = []
    for p, pieces in parts.items():
        merged = []
        for s, e in sorted(pieces):
            if merged and s <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], e)
            else:
                merged.append([s, e])
        out += [(s, e - s + p, p) for s, e in merged if e - s + p >= max(12, 2 * p)]
    return sorted(out)


def plain_row(doc_id, text, change=op11.planted):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    words = [w.decode() for w in change(doc_id, [w.encode() for w in words])] if change else words
    runs = sorted(plain_runs(words), key=lambda r: (r[0], r[2]))
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return {
        "doc_id": doc_id,
        "n_words": len(words),
        "n_runs": len(runs),
        "start": best and best[0],
        "length": best and best[1],
        "period": best and best[2],
        "exponent_milli": best and 1000 * best[1] // best[2],
        "runs_sha256": digest("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
        "collapsed_sha256": digest(" ".join(w for i, w in enumerate(words) if i not in dropped)),
    }


def periodic(rng, n):
    """Words with runs of many periods, powers within powers, and noise between."""
    out = []
    while len(out) < n:
        block = [rng.choice("abcd") for _ in range(rng.choice([1, 1, 2, 3, 5, 8, 17, 40, 90]))]
        block = block * rng.choice([1, 1, 2, 3])
        out += (block * rng.choice([1, 2, 3, 7]))[: rng.randrange(1, 300)]
        out += [rng.choice("abcdefgh") for _ in range(rng.choice([0, 0, 1, 20]))]
    return out[:n]


@pytest.mark.parametrize("seed", range(40))
def test_steps_against_brute_force(seed):
    rng = random.Random(seed)
    words = periodic(rng, rng.randrange(1, 700))
    wanted = plain_runs(words)
    assert engine_runs(words) == wanted
    assert engine_runs(words, 1) == wanted


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("ab"), max_size=80))
def test_two_words(words):
    assert engine_runs(words) == plain_runs(words)


def test_periods_near_octaves():
    for q in [1, 2, 3, 4, 5, 6, 7, 8, 11, 12, 15, 16, 17, 20, 21, 31, 32, 33, 63, 64, 65, 127, 128, 200]:
        block = [f"b{i}" for i in range(q)]
        for extra in (-1, 0, 1):
            n = max(12, 2 * q) + extra
            for lead in (0, 1, 5, 16, 37):
                words = [f"l{i}" for i in range(lead)] + [block[i % q] for i in range(n)] + ["end"]
                assert engine_runs(words) == plain_runs(words) == ([(lead, n, q)] if extra >= 0 else [])


def test_z_function():
    rng = random.Random(1)
    for _ in range(200):
        words = [rng.randrange(2) for _ in range(rng.randrange(30))]
        wanted = [next((k for k in range(len(words) - i) if words[k] != words[i + k]), len(words) - i) for i in range(len(words))]
        assert op11.z_of(np.array(words, np.int32)).tolist() == wanted


def test_odd_rows(spark):
    rng = random.Random(3)
    docs = [*ODD, (30, "a b " * 9), (31, "é " * 12), (32, "x " * 11), (33, "v\x0bt\x0cu v " * 12)]
    docs += [(100 + i, " ".join(periodic(rng, 200))) for i in range(60)] + [(0, "w " * 3_000), (0, "w " * 3_000)]
    for change in (op11.planted, None):
        got = rows(op11.periodic_runs(docs_of(spark, docs, clashing=True), change))
        assert sorted(got, key=str) == sorted((plain_row(*d, change) for d in docs), key=str)
    assert op11.periodic_runs(docs_of(spark, [])).count() == 0


def test_long_text_in_many_tiles(spark):
    """A document of 300,000 words whose runs lie across hundreds of rows of tiles."""
    words = [f"u{i}" for i in range(1_000)] + ["a", "b", "c"] * 40_000 + [f"v{i}" for i in range(50_000)] * 2
    words += ["z"] * 79_000
    wanted = [(1_000, 120_000, 3), (121_000, 100_000, 50_000), (221_000, 79_000, 1)]
    row = op11.periodic_runs(docs_of(spark, [(None, " ".join(words))])).collect()[0]
    listing = "".join(f"{s},{n},{q}\n" for s, n, q in wanted)
    assert (row.n_runs, row.start, row.length, row.period) == (3, 1_000, 120_000, 3)
    assert row.runs_sha256 == hashlib.sha256(listing.encode()).hexdigest()


def test_given_documents(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    docs = [(r.doc_id, r.text) for r in table.filter("n_chars < 4000").collect()]
    got = {r["doc_id"]: r for r in rows(op11.op11_periodic_runs(spark, SF))}
    assert len(got) == table.count()
    for doc_id, text in docs:
        assert got[doc_id] == plain_row(doc_id, text)
    assert sum(r["n_runs"] > 0 for r in got.values()) >= 10
