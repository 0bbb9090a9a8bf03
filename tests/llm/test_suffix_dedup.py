import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from corpuslab.llm import op03_suffix_dedup as op3

from .helpers import ODD, docs_of, rows

SF = "/root/testdata/sf0.001"


def plain(docs):
    order = lambda d: op3.LAST if d is None else d
    first = {}
    raw = [(d, (t or "").encode()) for d, t in docs]
    for d, t in raw:
        for i in range(len(t) - 49):
            w = t[i : i + 50]
            first[w] = min(first.get(w, op3.LAST), order(d))
    out = []
    for d, t in raw:
        gone = bytearray(len(t))
        for i in range(len(t) - 49):
            if first[t[i : i + 50]] < order(d):
                gone[i : i + 50] = b"\1" * 50
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append(
            {
                "doc_id": d,
                "n_bytes": len(t),
                "n_removed": sum(gone),
                "n_spans": spans,
                "kept_sha256": hashlib.sha256(kept).hexdigest(),
            }
        )
    return sorted(out, key=str)


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 8))) for _ in range(n))


def corpus(seed):
    rng = random.Random(seed)
    line = prose(rng, 12)
    docs = []
    for i in range(60):
        kind = rng.randrange(6)
        text = prose(rng, rng.randint(1, 60))
        if kind == 1 and docs:
            text = rng.choice(docs)[1] or ""
        elif kind == 2 and docs:
            old = rng.choice(docs)[1] or ""
            at = rng.randint(0, len(old))
            text = old[:at] + rng.choice(["é", "", "xyz "]) + old[at + rng.randint(0, 3) :]
        elif kind == 3:
            text = text + "\n" + line + prose(rng, 3) + line + "\n"
        elif kind == 4:
            text = line[: rng.randint(30, len(line))] * rng.randint(1, 3) + text
        docs.append((rng.choice([i, i, i, 7, None]), text))
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize("seed", range(3))
def test_against_every_window(spark, seed):
    docs = corpus(seed)
    assert sorted(rows(op3.remove_repeats(docs_of(spark, docs, clashing=True))), key=str) == plain(docs)


def test_very_frequent_anchors_by_window(spark, monkeypatch):
    monkeypatch.setattr(op3, "HOT_TEXTS", 2)
    monkeypatch.setattr(op3, "RECORDS", 50)
    monkeypatch.setattr(op3, "GROUP_BYTES", 400)
    docs = corpus(5)
    assert sorted(rows(op3.remove_repeats(docs_of(spark, docs))), key=str) == plain(docs)


@pytest.mark.parametrize("most", [1, 10_000])
def test_frequent_anchors_are_not_gathered(spark, monkeypatch, most):
    monkeypatch.setattr(op3, "HOT_TEXTS", 2)
    monkeypatch.setattr(op3, "HOT_LIST", most)
    monkeypatch.setattr(op3, "LOCAL", 1)
    monkeypatch.setattr(op3, "FLUSH", 100)
    monkeypatch.setattr(op3, "GROUP_BYTES", 400)
    docs = [*corpus(7), *corpus(8)]
    found = {}
    anchor_rows = op3.anchor_rows

    def listed(texts, buckets, hot):
        found["hot"], found["rows"] = hot, anchor_rows(texts, buckets, hot)
        return found["rows"]

    monkeypatch.setattr(op3, "anchor_rows", listed)
    assert sorted(rows(op3.remove_repeats(docs_of(spark, docs))), key=str) == plain(docs)
    assert 0 < len(found["hot"]) <= most
    sent = [op3.unpacked(r["value"], "<u8", "<i4", "<u4", "V6")[3] for r in rows(found["rows"])]
    assert not np.isin(op3.long(np.concatenate(sent)), found["hot"]).any()


def test_large_sides_are_shuffled(spark, monkeypatch):
    monkeypatch.setattr(op3.checked, "__defaults__", (0,))
    docs = corpus(6)
    assert sorted(rows(op3.remove_repeats(docs_of(spark, docs))), key=str) == plain(docs)


def test_odd_rows(spark):
    same = "0123456789" * 30
    docs = [*ODD, (60, "a" * 400), (61, "a" * 49), (62, "b" + "a" * 50), (63, "\0" * 120), (64, "\0" * 70 + "x"), (70, same), (70, same), (71, same), (None, same), (72, same[3:])]
    assert sorted(rows(op3.remove_repeats(docs_of(spark, docs))), key=str) == plain(docs)
    assert op3.remove_repeats(docs_of(spark, [])).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 6), st.integers(50, 90), st.integers(2, 3), st.randoms())
def test_refined_buckets(count, width, letters, rng):
    data = np.array([[rng.randrange(letters) for _ in range(width)] for _ in range(count)], np.uint8)
    if count > 1:
        data[1, 5:] = data[0, :-5]
    buckets = op3.refine(data)
    strings = [[data[i, j : j + 50].tobytes() for j in range(width - 49)] for i in range(count)]
    flat = sorted((s, int(b)) for own, found in zip(strings, buckets) for s, b in zip(own, found))
    # Buckets are numbered in the order of their strings, and equal only for equal ones.
    assert all((x[0] == y[0]) == (x[1] == y[1]) and x[1] <= y[1] for x, y in zip(flat, flat[1:]))


def test_runs_cover_long_texts(monkeypatch):
    rng = random.Random(1)
    text = prose(rng, 3000).encode()
    held = op3.Powers()
    whole = op3.anchors([text, text[7:900]], held)
    monkeypatch.setattr(op3, "RUN", 1000)
    cut = op3.anchors([text, text[7:900]], held)

    def windows(found):
        _, _, doc, place, first, last, ids = found
        return sorted({(d, w, p, i) for d, p, f, x, i in zip(doc, place, first, last, ids) for w in range(f, x + 1)})

    assert windows(whole) == windows(cut)
    assert len({w for _, w, _, _ in windows(cut)}) == len(text) - 49 + 893 - 49


def test_query(spark):
    table = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted(rows(op3.op3_suffix_dedup(spark, SF)), key=str) == plain(table)
