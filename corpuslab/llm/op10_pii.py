"""Personal data: wide generators propose overlapping spans, boosted trees
score them by format and context, calibrated thresholds select.

The plain patterns (``base_spans``) are always redacted. The trees add what
these cannot match: addresses and numbers written in other ways. Their labels
are made from the plain spans of all texts, rewritten in place: a span in
another spelling ("at" for @, other separators, no "+") is a positive, the same
with broken digits (no check sum, parts above 255, too few) is a negative, and
so is every proposal that no plain span touches. Format, check sums and context
are features. A third of the texts is held out, its scores are calibrated by
isotonic regression, and each kind's threshold is the smallest score whose
calibrated precision reaches the target; a kind without such a score adds
nothing.

The trees see places between quantiles, so spans with equal features are one
row with a number. Slopes and bends are added up as whole numbers, on the driver
or, where the different rows are more than ``HELD_ROWS``, on the executors: the
trees are the same, however the rows are dealt.

Null and empty texts have no spans; very long texts are searched whole, in time
that grows with their length; of overlapping selected spans the one with the
highest score stays, of equal scores the first; repeated rows are each
searched, and fitted on once; an empty table or one without plain spans adds no
spans; other columns pass unread.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from corpuslab.session import scratch_tables, via_table

from .common import bounded_batches, documents, map_batches, texts

KINDS = ("email", "ip", "card", "phone")
#: Different rows of made spans that the driver fits on by itself; it is also the rows of a block on the executors.
HELD_ROWS = 200_000
PRECISION = 0.98
TREES, DEPTH, RATE, BINS = 60, 4, 0.2, 32
CONTEXT = 40
#: Features are whole numbers below 65,536: a proposal has less than a thousand characters.
PACKED = np.dtype("<u2")
#: Slopes and bends are counted in parts of 1 / UNIT, so that sums of some 8e9 spans are exact.
UNIT = 1 << 20
#: The place after which a node without a split would cut; it has no larger ones.
NOWHERE = 255

# The plain patterns.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

DIGIT, NUMBER = re.compile(r"[0-9]"), re.compile(r"[0-9]+")
SPELLED = re.compile(r"\b(?:at|dot)\b")
#: Wide proposals by kind; they overlap each other and the plain spans.
PROPOSALS = {
    "email": re.compile(
        r"[\w.%+-]{1,64}\s?(?:@|\(at\)|\[at\]|\sat\s)\s?[\w-]{1,63}(?:\s?(?:\.|\(dot\)|\[dot\]|\sdot\s)\s?[A-Za-z0-9-]{2,63}){1,8}"
    ),
    "ip": re.compile(
        r"(?<![0-9A-Za-z:.])(?:[0-9]{1,6}(?:(?:[.:-]|\[\.\]|\(\.\)| dot )[0-9]{1,6}){2,8}|[0-9A-Fa-f]{1,4}(?::{1,2}[0-9A-Fa-f]{1,4}){3,7})"
    ),
    "card": re.compile(r"(?<![0-9])[0-9](?:[ ./_-]{0,2}[0-9]){11,23}"),
    "phone": re.compile(r"(?<![0-9])(?:\+|00)?[(]?[0-9](?:[ ().\-/]{0,3}[0-9]){6,16}"),
}
CUES = {
    "email": re.compile(r"mail|contact|write|kontakt|correo|courriel", re.I),
    "ip": re.compile(r"\bip\b|address|host|server|login|adresse", re.I),
    "card": re.compile(r"card|visa|credit|pay|karte|carte|tarjeta", re.I),
    "phone": re.compile(r"phone|tel|call|mobile|fax|anruf|appel|llama", re.I),
}
#: Other spellings: of @ and dots in addresses, of dots in numbers, of gaps between groups of digits.
AT, DOT = [" at ", "(at)", "[at]", " (at) "], [" dot ", "(dot)", "[dot]", "."]
POINT, GAP = ["[.]", "(.)", " dot ", "-"], [".", "/", "_", "  ", " - ", ". "]
MARK = {kind: f"<{kind.upper()}>" for kind in KINDS}


# ---- plain spans


def emails(text: str):
    """Leftmost non-overlapping addresses: before each @ the longest run of
    local characters after the last match, so the cost is linear."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            end = domain.end()
        at = text.find("@", max(at + 1, end))


def luhn(digits: str) -> bool:
    doubled = [int(d) for d in digits[-2::-2]]
    return (sum(int(d) for d in digits[::-2]) + sum(2 * d - 9 * (d > 4) for d in doubled)) % 10 == 0


def valid(kind: str, found: str) -> bool:
    if kind == "ip":
        parts = [p.lstrip("0") or "0" for p in found.split(".")]
        return all(len(p) <= 3 and int(p) <= 255 for p in parts)
    digits = "".join(c for c in found if "0" <= c <= "9")
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of every plain span, sorted."""
    found = [(s, 0, e) for s, e in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        for kind, pattern in ((1, IP), (2, CARD), (3, PHONE)):
            found += [(m.start(), kind, m.end()) for m in pattern.finditer(text) if valid(KINDS[kind], m.group())]
    return sorted(found)


# ---- proposals and their features


def proposals(text: str) -> list[tuple[int, int, int]]:
    address = "@" in text or "(at)" in text or "[at]" in text or (" at " in text and " dot " in text)
    number = bool(DIGIT.search(text))
    return [
        (m.start(), kind, m.end())
        for kind, name in enumerate(KINDS)
        if (address if name == "email" else number)
        for m in PROPOSALS[name].finditer(text)
    ]


def features(text: str, span: tuple[int, int, int]) -> list[float]:
    start, kind, end = span
    found = text[start:end]
    before, after = text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]
    groups = [len(g) for g in NUMBER.findall(found)]
    near = re.findall(r"\w+", before)[-3:]
    return [
        *(float(kind == k) for k in range(len(KINDS))),
        len(found),
        sum(groups),
        len(groups),
        max(groups, default=0),
        min(groups, default=0),
        found.count("."),
        found.count("-"),
        found.count(" "),
        found.count("("),
        found.count(":"),
        found.count("@"),
        sum(c.isalpha() for c in found),
        float(found[0] == "+"),
        float(found[-1:].isdigit()),
        float(before[-1:].isalnum()),
        float(before[-1:] in ".-:/_"),
        float(after[:1].isalnum()),
        float(after[:1] in "-:/_%"),
        float(luhn("".join(DIGIT.findall(found)))) if groups else 0.0,
        float(bool(groups) and max(map(len, NUMBER.findall(found))) <= 3 and all(int(g) <= 255 for g in NUMBER.findall(found))),
        float(found[:2] == "00"),
        len(SPELLED.findall(found)),
        len({c for c in found if not c.isalnum()}),
        *(float(bool(CUES[k].search(" ".join(near)))) for k in KINDS),
    ]


# ---- boosted trees


@dataclass(frozen=True)
class Trees:
    """Complete trees of one depth: split feature and value of each inner node,
    value of each leaf."""

    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    thresholds: tuple[float, ...]

    def score(self, rows: np.ndarray) -> np.ndarray:
        total = np.zeros(len(rows))
        every = np.arange(len(rows))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(rows), np.int64)
            while len(node) and node[0] < len(feature):
                node = 2 * node + 1 + (rows[every, feature[node]] > cut[node])
            total += leaf[node - len(feature)] if len(node) else 0
        return total


class Rows:
    """Different rows of made spans: the places of their features between the
    cuts, how many spans they stand for, how many of these are positive, and
    their score by the trees so far."""

    def __init__(self, places: np.ndarray, good: np.ndarray, n: np.ndarray):
        self.places, self.good, self.n = np.ascontiguousarray(places.T), good, n
        self.score, self.every = np.zeros(len(n)), np.arange(len(n))

    def node(self, feature: np.ndarray, cut: np.ndarray, level: int) -> np.ndarray:
        """The node of a tree that each row reaches at ``level``, from 0."""
        node = np.zeros(len(self.n), np.int64)
        for _ in range(level):
            node = 2 * node + 1 + (self.places[feature[node], self.every] > cut[node])
        return node - ((1 << level) - 1)

    def sums(self, feature: np.ndarray, cut: np.ndarray, level: int) -> np.ndarray:
        """Slopes and bends by node of the level, feature and place, in whole parts."""
        chance = 1 / (1 + np.exp(-self.score))
        slope = np.rint((self.good - self.n * chance) * UNIT)
        bend = np.rint(self.n * np.maximum(chance * (1 - chance), 1e-6) * UNIT)
        node, size = self.node(feature, cut, level) * BINS, BINS << level
        cells = [[np.bincount(node + p, v, size).reshape(-1, BINS) for v in (slope, bend)] for p in self.places]
        return np.array(cells).transpose(2, 0, 3, 1)

    def add(self, feature: np.ndarray, cut: np.ndarray, leaf: np.ndarray) -> None:
        self.score += leaf[self.node(feature, cut, DEPTH)]


def rows_of(held: Iterable[pa.RecordBatch]) -> Rows:
    table = pa.Table.from_batches(held)
    places = np.frombuffer(b"".join(table["places"].to_pylist()), np.uint8)
    good, n = (table[c].to_numpy().astype(float) for c in ("good", "n"))
    return Rows(places.reshape(len(n), -1), good, n)


def blocks(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[list[pa.RecordBatch]]:
    """Batches in lists of at least ``size`` rows, but the last one."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) >= size:
            yield held
            held = []
    if held:
        yield held


class SpreadRows:
    """The same for rows that stay in a table: the executors follow the trees so
    far and send a sum per task."""

    def __init__(self, table: DataFrame):
        self.table = table.select("places", "good", "n").coalesce(table.sparkSession.sparkContext.defaultParallelism)
        self.trees: list[tuple] = []

    def sums(self, feature: np.ndarray, cut: np.ndarray, level: int) -> np.ndarray:
        trees, size = list(self.trees), HELD_ROWS

        def run(batches):
            total = None
            for held in blocks(batches, size):
                rows = rows_of(held)
                for tree in trees:
                    rows.add(*tree)
                found = rows.sums(feature, cut, level)
                total = found if total is None else total + found
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

        found = self.table.mapInArrow(run, "sums binary").collect()
        return sum(np.frombuffer(r["sums"]).reshape(1 << level, -1, BINS, 2) for r in found)

    def add(self, *tree: np.ndarray) -> None:
        self.trees.append(tree)


def boost(rows: Rows | SpreadRows, cuts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gradient boosting for the logistic loss, splits at the places of
    ``cuts``: split feature and place of each inner node, value of each leaf."""
    inner = (1 << DEPTH) - 1
    out = []
    for _ in range(TREES):
        feature, cut, leaf = np.zeros(inner, np.int64), np.full(inner, NOWHERE), np.zeros(inner + 1)
        for level in range(DEPTH):
            # node, feature, place, (slope, bend)
            cells = rows.sums(feature, cut, level) / UNIT
            whole, left = cells[:, 0].sum(axis=1), cells.cumsum(axis=2)
            right = whole[:, None, None] - left
            gain = left[..., 0] ** 2 / (left[..., 1] + 1) + right[..., 0] ** 2 / (right[..., 1] + 1)
            for k, at in enumerate(range((1 << level) - 1, (2 << level) - 1)):
                best = whole[k, 0] ** 2 / (whole[k, 1] + 1)
                for f, points in enumerate(cuts):
                    i = int(np.argmax(gain[k, f, : len(points)])) if len(points) else 0
                    if len(points) and gain[k, f, i] > best + 1e-9:
                        best, feature[at], cut[at] = gain[k, f, i], f, i
                if level == DEPTH - 1:
                    sides = (left[k, feature[at], cut[at]], right[k, feature[at], cut[at]]) if cut[at] < NOWHERE else (whole[k], np.zeros(2))
                    leaf[2 * k : 2 * k + 2] = [RATE * g / (h + 1) for g, h in sides]
        rows.add(feature, cut, leaf)
        out.append((feature, cut, leaf))
    return tuple(np.array(p) for p in zip(*out, strict=True))


def isotonic_threshold(scored: Iterable[tuple[float, float, float]], precision: float) -> float:
    """Smallest score whose isotonic estimate of precision reaches the target,
    from different scores in order with the positives and all of each."""
    steps: list[list[float]] = []  # [positives, rows, smallest score]
    for value, good, rows in scored:
        steps.append([good, rows, value])
        while len(steps) > 1 and steps[-2][0] * steps[-1][1] >= steps[-1][0] * steps[-2][1]:
            good, rows, _ = steps.pop()
            steps[-1][0] += good
            steps[-1][1] += rows
    return next((b[2] for b in steps if b[0] >= precision * b[1]), float("inf"))


def calibrated_threshold(scores: np.ndarray, labels: np.ndarray, precision: float, n: np.ndarray | None = None) -> float:
    """``isotonic_threshold`` of scores with their positives, of ``n`` spans each, else of one."""
    values, place = np.unique(scores, return_inverse=True)
    sums = (np.bincount(place, w, len(values)).tolist() for w in (labels, n))
    return isotonic_threshold(zip(values.tolist(), *sums, strict=True), precision)


def quantiles(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Different cuts at the quantiles of values in order, each as often as it counts."""
    ends = np.cumsum(counts)
    at = np.linspace(0, 1, BINS + 1)[1:-1] * (ends[-1] - 1)
    low = np.floor(at).astype(np.int64)
    below, above = (values[np.searchsorted(ends, i, "right")] for i in (low, np.minimum(low + 1, ends[-1] - 1)))
    return np.unique(below + (above - below) * (at - low))


def digits_in_groups(digits: str, choose: random.Random) -> str:
    """Digits in groups of three or four with one gap of another kind."""
    size, gap = choose.choice([3, 4, 4]), choose.choice(GAP)
    return gap.join(digits[i : i + size] for i in range(0, len(digits), size))


def respelled(kind: str, found: str, choose: random.Random) -> str:
    """A plain span as the plain pattern does not match it."""
    if kind == "email":
        name, _, domain = found.rpartition("@")
        return name + choose.choice(AT) + domain.replace(".", choose.choice(DOT))
    if kind == "ip":
        return found.replace(".", choose.choice(POINT))
    digits = "".join(DIGIT.findall(found))
    if kind == "card":
        return digits_in_groups(digits, choose)
    return choose.choice(["00", "(", ""]) + digits_in_groups(digits, choose)


def broken(kind: str, found: str, choose: random.Random) -> str | None:
    """The span with digits that make it none of its kind."""
    if kind == "ip":
        return ".".join(str(int(p[:3]) + choose.choice([256, 700, 4_000])) for p in found.split("."))
    if kind == "card":
        last = choose.choice([d for d in "0123456789" if d != found[-1]])
        return found[:-1] + last
    if kind == "phone":
        digits = "".join(DIGIT.findall(found))
        return choose.choice([digits[:7], digits * 2])
    return None


def made_spans(text: str) -> Iterator[tuple[list[float], bool]]:
    """Features and labels from one text: rewritten plain spans, and proposals
    that no plain span touches."""
    plain = base_spans(text)
    for start, kind, end in plain:
        found, name = text[start:end], KINDS[kind]
        choose = random.Random(f"{name}:{found}")
        wrong = broken(name, found, choose)
        spellings = [(respelled(name, found, choose), True)]
        spellings += [(respelled(name, wrong, choose), False), (wrong, False)] if wrong else []
        before, after = text[max(0, start - 2 * CONTEXT) : start], text[end : end + 2 * CONTEXT]
        for spelling, right in spellings:
            around = before + spelling + after
            low, high = len(before), len(before) + len(spelling)
            for span in proposals(around):
                if span[0] < high and low < span[2]:
                    exact = span[1] == kind and low <= span[0] <= low + 1 and span[2] == high
                    yield features(around, span), right and exact
    ends = np.maximum.accumulate([0, *(e for _, _, e in plain)])
    starts = [s for s, _, _ in plain]
    for span in proposals(text):
        at = bisect_left(starts, span[2])
        if ends[at] <= span[0]:
            yield features(text, span), False


def span_rows(docs: DataFrame) -> DataFrame:
    """The made spans of all different texts by their features: whether held
    out, which goes by whole texts, positives (``good``) and all (``n``)."""

    def make():
        def step(rows):
            out = {"id": [], "held": [], "features": [], "good": [], "n": []}
            for text in rows["text"]:
                good, n = Counter(), Counter()
                for values, label in made_spans(text):
                    key = np.array(values, PACKED).tobytes()
                    good[key] += label
                    n[key] += 1
                if n:
                    raw = text.encode()
                    out["id"].append(hashlib.blake2b(raw, digest_size=16).digest())
                    out["held"].append(int(hashlib.blake2b(raw, digest_size=8).hexdigest(), 16) % 3 == 2)
                    out["features"].append(list(n))
                    out["good"].append([good[k] for k in n])
                    out["n"].append(list(n.values()))
            yield out

        return step

    found = map_batches(
        texts(docs).select("text"), make, "id binary, held boolean, features array<binary>, good array<bigint>, n array<bigint>"
    )
    different = found.dropDuplicates(["id"])
    each = different.select("held", F.inline(F.arrays_zip("features", "good", "n")))
    return each.groupBy("held", "features").agg(F.sum("good").alias("good"), F.sum("n").alias("n"))


def unpacked(features: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(features), PACKED).reshape(len(features), -1)


def cuts_of(spans: DataFrame) -> list[np.ndarray]:
    """The cuts of each feature, at the quantiles of all ``spans``: whole
    numbers with their counts are few."""

    def make():
        counts: Counter = Counter()

        def step(rows):
            n = np.array(rows["n"], float)
            for f, values in enumerate(unpacked(rows["features"]).T):
                sums = np.bincount(values, n)
                counts.update({(f, int(v)): int(sums[v]) for v in np.flatnonzero(sums)})
            return ()

        def finish():
            yield {"feature": [f for f, _ in counts], "value": [v for _, v in counts], "n": list(counts.values())}

        step.finish = finish
        return step

    partial = map_batches(spans.select("features", "n"), make, "feature int, value int, n bigint")
    found = sorted(partial.groupBy("feature", "value").agg(F.sum("n").alias("n")).collect())
    by_feature: dict[int, list] = {}
    for r in found:
        by_feature.setdefault(r["feature"], []).append((r["value"], r["n"]))
    return [quantiles(np.array([v for v, _ in own], float), np.array([n for _, n in own])) for own in by_feature.values()]


def placed(spans: DataFrame, cuts: list[np.ndarray]) -> DataFrame:
    """Spans by the places of their features: x <= cuts[i] goes left of cut i."""

    def make():
        def step(rows):
            values = unpacked(rows["features"])
            places = np.array([np.searchsorted(points, v) for points, v in zip(cuts, values.T, strict=True)], np.uint8).T
            yield {
                "held": rows["held"],
                "kind": values[:, : len(KINDS)].argmax(axis=1).astype(np.int32),
                "places": [p.tobytes() for p in places],
                "good": rows["good"],
                "n": rows["n"],
            }

        return step

    each = map_batches(spans, make, "held boolean, kind int, places binary, good bigint, n bigint")
    return each.groupBy("held", "kind", "places").agg(F.sum("good").alias("good"), F.sum("n").alias("n"))


def held_thresholds(rows: DataFrame, trees: list[tuple], precision: float, spread: bool) -> tuple[float, ...]:
    """Each kind's threshold on the rows held out."""

    def score(batches):
        for held in blocks(batches, size):
            table, own = pa.Table.from_batches(held), rows_of(held)
            for tree in trees:
                own.add(*tree)
            columns = [table["kind"].combine_chunks(), pa.array(own.score), *(table[c].combine_chunks() for c in ("good", "n"))]
            yield pa.RecordBatch.from_arrays(columns, names=["kind", "score", "good", "n"])

    size = HELD_ROWS
    if not spread:
        found = list(score(rows.toArrow().to_batches()))
        kind, scores, good, n = (np.concatenate([np.zeros(0), *(b.column(i).to_numpy() for b in found)]) for i in range(4))
        return tuple(calibrated_threshold(scores[kind == k], good[kind == k], precision, n[kind == k]) for k in range(len(KINDS)))
    each = rows.mapInArrow(score, "kind int, score double, good bigint, n bigint")
    scored = via_table(each.groupBy("kind", "score").agg(F.sum("good").alias("good"), F.sum("n").alias("n")), "pii-scores")
    return tuple(
        isotonic_threshold(
            ((r["score"], r["good"], r["n"]) for r in scored.filter(F.col("kind") == k).orderBy("score").toLocalIterator()), precision
        )
        for k in range(len(KINDS))
    )


def train(docs: DataFrame, precision: float = PRECISION) -> Trees | None:
    """Trees and thresholds, or None where the spans to fit on are of one class."""
    with scratch_tables():
        spans = via_table(span_rows(docs), "pii-spans")
        fitted = spans.filter(~F.col("held"))
        good, n = fitted.agg(F.sum("good"), F.sum("n")).first()
        if not good or good == n:
            return None
        cuts = cuts_of(fitted)
        rows = via_table(placed(spans, cuts), "pii-rows")
        spread = rows.count() > HELD_ROWS
        own, held = rows.filter(~F.col("held")), rows.filter("held")
        feature, place, leaf = boost(SpreadRows(own) if spread else rows_of(own.toArrow().to_batches()), cuts)
        trees = list(zip(feature, place, leaf, strict=True))
        thresholds = held_thresholds(held, trees, precision, spread)
    values = np.array([np.append(points, np.full(NOWHERE + 1 - len(points), np.inf)) for points in cuts])
    return Trees(feature, values[feature, place], leaf, thresholds)


def all_spans(text: str, trees: Trees | None) -> tuple[list, list]:
    """The plain spans, and these with the selected proposals. Where selected
    proposals overlap, the highest score stays."""
    plain = base_spans(text)
    offered = proposals(text) if trees else []
    if not offered:
        return plain, plain
    scores = trees.score(np.array([features(text, s) for s in offered]))
    passed = [(-v, s) for v, s in zip(scores.tolist(), offered, strict=True) if v >= trees.thresholds[s[1]]]
    # Intervals that are taken, apart from each other and in order, so only neighbours can overlap a span.
    begins, ends, added = [], [], []
    for start, _, end in plain:
        if begins and start < ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            begins.append(start)
            ends.append(end)
    for _, span in sorted(passed):
        at = bisect_left(begins, span[2])
        if not at or ends[at - 1] <= span[0]:
            begins.insert(at, span[0])
            ends.insert(at, span[2])
            added.append(span)
    return plain, sorted([*plain, *added])


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def personal_data(docs: DataFrame, trees: Trees | None) -> DataFrame:
    """Per row: doc_id, plain spans by kind, and all spans."""

    def make():
        def step(rows):
            pairs = [all_spans(text, trees) for text in rows["text"]]
            yield {
                "doc_id": rows["doc_id"],
                **{f"n_{k}": [sum(s[1] == i for s in plain) for plain, _ in pairs] for i, k in enumerate(KINDS)},
                "base_sha256": [hashlib.sha256(written(plain).encode()).hexdigest() for plain, _ in pairs],
                "spans": [written(every) for _, every in pairs],
            }

        return step

    counts = ", ".join(f"n_{k} bigint" for k in KINDS)
    return map_batches(texts(docs), make, f"doc_id bigint, {counts}, base_sha256 string, spans string")


def redact(text: str | None, trees: Trees | None) -> str | None:
    """The text with every span replaced by the name of its kind; overlapping
    spans are one."""
    if not text:
        return text
    merged: list[list[int]] = []
    for start, kind, end in all_spans(text, trees)[1]:
        if merged and start < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], end)
        else:
            merged.append([start, kind, end])
    if not merged:
        return text
    ends = [0, *(m[2] for m in merged)]
    parts = [text[e : m[0]] + MARK[KINDS[m[1]]] for e, m in zip(ends, merged, strict=False)]
    return "".join(parts) + text[ends[-1] :]


def redacted(docs: DataFrame, trees: Trees | None) -> DataFrame:
    """All rows and columns, with the texts redacted."""
    bounded_batches(docs.sparkSession)
    kind = pa.string()

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts_out = pa.array([redact(t, trees) for t in batch.column(at).to_pylist()], kind)
            columns = [texts_out if i == at else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(run, docs.schema)


def op10_pii(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    return personal_data(docs, train(docs))
