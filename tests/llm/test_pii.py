import hashlib
import re
from collections import Counter

import numpy as np
from hypothesis import given, settings, strategies as st

from corpuslab.llm import op10_pii as op10

from .helpers import ODD, docs_of, rows

SF = "/root/testdata/sf0.001"

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def checked(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        total = 0
        for i, d in enumerate(map(int, reversed(digits))):
            total += d if i % 2 == 0 else sum(map(int, str(2 * d)))
        return 14 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def plain(text):
    found = [
        (m.start(), i, m.end())
        for i, (kind, pattern) in enumerate(PATTERNS.items())
        for m in re.finditer(pattern, text or "")
        if checked(kind, m.group())
    ]
    return sorted(found)


@settings(max_examples=500, deadline=None)
@given(st.text(st.sampled_from("a1@.-_+ 90()é\n"), max_size=40))
def test_plain_spans(text):
    assert op10.base_spans(text) == plain(text)


def test_plain_spans_of_formats():
    text = "x.y@a.b_d@e.f 1.2.3.4.5.6.7.8 256.1.1.1 4111 1111-1111 1111 +1 (545) 555-5362 a@b@c.d 000300.1.1.1"
    assert op10.base_spans(text) == plain(text) and len(plain(text)) >= 6


def test_very_long_runs():
    assert op10.base_spans("a" * 200_000 + " @ " + "1" * 200_000 + "." * 1000) == []
    assert op10.proposals("a" * 200_000)[:1] == []


MORE = [
    *ODD,
    (30, "Mail a.b@c.example.com or call +1 (545) 555-5362, card 4111 1111 1111 1111, host 10.0.0.1"),
    (31, "call 545 555 5362 now; version 1.2.3; year 2024"),
    (32, "b@c.de" + " x" * 300 + " b@c.de"),
]


def test_odd_rows(spark):
    got = rows(op10.personal_data(docs_of(spark, MORE, clashing=True), None))
    want = []
    for doc_id, text in MORE:
        spans = plain(text)
        line = ",".join(f"{op10.KINDS[k]}:{s}:{e}" for s, k, e in spans)
        counts = {f"n_{k}": sum(s[1] == i for s in spans) for i, k in enumerate(op10.KINDS)}
        want.append({"doc_id": doc_id, **counts, "base_sha256": hashlib.sha256(line.encode()).hexdigest(), "spans": line})
    assert sorted(got, key=str) == sorted(want, key=str)


def people(n):
    for i in range(n):
        card = f"4{i:014d}"
        card += next(str(d) for d in range(10) if op10.luhn(card + str(d)))
        yield i, f"call +1 (545) 555-{i:04d} or mail u{i}@mail{i}.example.com card {card} then {i}.{i}.{i} and {1000 + i}-{i}"


def added(text, trees):
    base, every = op10.all_spans(text, trees)
    assert set(base) <= set(every)
    return [(op10.KINDS[k], text[s:e]) for s, k, e in every if (s, k, e) not in base]


def card(number):
    start = f"4{number:014d}"
    return start + next(str(d) for d in range(10) if op10.luhn(start + str(d)))


def test_other_spellings_are_added_and_look_alikes_are_not(spark):
    """Spans that no plain pattern matches and no training text holds; without the trees there are none."""
    trees = op10.train(docs_of(spark, list(people(400))))
    # A kind without a plain span in the sample has no threshold; the others have one.
    assert [k for k, t in zip(op10.KINDS, trees.thresholds) if np.isfinite(t)] == ["email", "card", "phone"]
    found, wrong, total = 0, 0, 0
    for i in range(60):
        number = card(777_000_000 + 31 * i)
        bad = number[:-1] + str((int(number[-1]) + 3) % 10)
        cut = lambda n, sep: sep.join(n[k : k + 4] for k in range(0, 16, 4))
        sep = [".", "/", "_", "  "][i % 4]
        spans = [f"who{i} at site{i} dot org", f"x.y{i}[at]far{i}.example.net", cut(number, sep)]
        for cue, text in zip(("mail", "write", "card"), spans, strict=True):
            around = f"or {cue} {text} if needed"
            assert op10.base_spans(around) == []
            total += 1
            found += any(text in span for _, span in added(around, trees))
            assert added(around, None) == []
        wrong += len(added(f"card {cut(bad, sep)} of it, version 3.{i}.7 of {1990 + i}", trees))
    assert found >= 0.9 * total and wrong <= 3
    for _, own in MORE:
        base, every = op10.all_spans(own or "", trees)
        more = [s for s in every if s not in base]
        assert all(a[2] <= s[0] or s[2] <= a[0] for a in more for s in every if s != a)
    quiet = "A clean text of 12 words, written in 2024, version 1.2.3, price 99."
    assert op10.all_spans(quiet, trees) == ([], [])


def test_all_spans_against_all_pairs(spark):
    """The sweep takes what comparing every pair takes, in a text of many numbers."""
    trees = op10.train(docs_of(spark, list(people(200))))
    text = " ".join(t for _, t in people(60)) + " " + " ".join(f"card {'/'.join(card(i)[k : k + 4] for k in range(0, 16, 4))} then" for i in range(60))
    plain = op10.base_spans(text)
    offered = op10.proposals(text)
    scores = trees.score(np.array([op10.features(text, s) for s in offered])).tolist()
    taken = list(plain)
    for _, span in sorted((-v, s) for v, s in zip(scores, offered) if v >= trees.thresholds[s[1]]):
        if all(span[2] <= o[0] or o[2] <= span[0] for o in taken):
            taken.append(span)
    assert op10.all_spans(text, trees) == (plain, sorted(taken)) and len(taken) > len(plain)


def test_sample_does_not_depend_on_partitions(spark):
    one, many = (op10.train(docs_of(spark, rows_).repartition(n)) for rows_, n in ((list(people(80)), 1), (list(people(80))[::-1], 5)))
    assert (one.leaf == many.leaf).all() and one.thresholds == many.thresholds


def test_all_texts_are_fitted_on(spark):
    """A kind that only stands in a few texts with the last hashes has a threshold, however many other spans there are."""
    key = lambda text: hashlib.blake2b(text.encode(), digest_size=8).hexdigest()
    mails = [f"mail u{i}@mail{i}.example.com now" for i in range(19_000)]
    hosts = [t for i in range(3_000) if key(t := f"the host {i % 250}.{i % 7}.{i % 11}.{i % 13} is up") >= "f"]
    assert len(hosts) > 100
    trees = op10.train(docs_of(spark, list(enumerate(mails + hosts))))
    assert [k for k, t in zip(op10.KINDS, trees.thresholds) if np.isfinite(t)] == ["email", "ip"]


def test_spans_by_features_against_all_spans(spark):
    docs = [*MORE, *people(50), *people(20)]
    want = Counter()
    for text in {t or "" for _, t in docs}:
        held = int(hashlib.blake2b(text.encode(), digest_size=8).hexdigest(), 16) % 3 == 2
        for values, label in op10.made_spans(text):
            want[held, tuple(values), label] += 1
    got = Counter()
    for r in op10.span_rows(docs_of(spark, docs, clashing=True)).collect():
        values = tuple(np.frombuffer(r["features"], op10.PACKED).astype(float))
        got[r["held"], values, True] += r["good"]
        got[r["held"], values, False] += r["n"] - r["good"]
    assert +got == want and len(want) > 50


def test_trees_on_the_executors_are_those_of_the_driver(spark, monkeypatch):
    monkeypatch.setattr(op10, "TREES", 3)
    docs = docs_of(spark, list(people(80)))
    held = op10.train(docs)
    monkeypatch.setattr(op10, "HELD_ROWS", 0)
    spread = op10.train(docs.repartition(5))
    for one, other in ((held.feature, spread.feature), (held.cut, spread.cut), (held.leaf, spread.leaf)):
        assert (one == other).all() and one.any()
    assert held.thresholds == spread.thresholds and np.isfinite(held.thresholds).any()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 40), min_size=1, max_size=120))
def test_quantiles_of_counted_values(values):
    found, counts = np.unique(np.array(values, float), return_counts=True)
    want = np.unique(np.quantile(np.array(values, float), np.linspace(0, 1, op10.BINS + 1)[1:-1]))
    assert np.allclose(op10.quantiles(found, counts), want, rtol=1e-12, atol=1e-12)


def test_calibration():
    scores = np.array([0.0, 1, 2, 3, 4, 5, 6, 7])
    labels = np.array([0, 0, 1, 0, 1, 1, 1, 1])
    assert op10.calibrated_threshold(scores, labels, 0.98) == 4
    assert op10.calibrated_threshold(scores, labels * 0, 0.98) == float("inf")
    assert op10.calibrated_threshold(scores[:0], labels[:0], 0.98) == float("inf")


def test_redacted_rows_keep_their_columns(spark):
    docs = docs_of(spark, MORE, clashing=True)
    out = op10.redacted(docs, None)
    assert out.schema == docs.schema and out.count() == len(MORE)
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts[30] == "Mail <EMAIL> or call <PHONE>, card <CARD>, host <IP>"
    assert texts[5] is None and texts[3] == "" and texts[9] == " lead and trail "


def test_empty_table(spark):
    docs = docs_of(spark, [])
    assert op10.train(docs) is None
    assert op10.personal_data(docs, None).count() == op10.redacted(docs, None).count() == 0


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = rows(op10.op10_pii(spark, SF))
    assert len(got) == len(texts)
    for r in got:
        spans = plain(texts[r["doc_id"]])
        line = ",".join(f"{op10.KINDS[k]}:{s}:{e}" for s, k, e in spans)
        assert r["base_sha256"] == hashlib.sha256(line.encode()).hexdigest()
        assert set(line.split(",")) - {""} <= set(r["spans"].split(","))
