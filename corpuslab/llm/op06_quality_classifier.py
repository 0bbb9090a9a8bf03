"""Quality classifier from weak labels.

Several heuristics vote on each text: good, bad, or no opinion. All documents
are counted by their pattern of votes, of which there are at most
3 ** len(LABELLERS). Expectation-maximisation on these counts estimates the
share of good texts and, for each heuristic, how often it votes which way on
good and on bad ones, without any true label. The posteriors of a bounded
sample of ``TRAIN_DOCS`` documents then train a logistic scorer on hashed
tokens, which scores every document; it also judges where the heuristics have
no opinion. The sample is chosen by a hash of the text; a text with copies is
one row of it, weighted by their number.

Null and empty texts get no opinion from any heuristic, and a score from how
varied they are; long texts are scored whole, in batches of bounded size;
repeated rows are each scored; scores of exactly one half are kept; an empty
table gives no rows; columns besides doc_id and text are not read. Where all of
the sample is of one class, every score is the estimated share.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import documents, map_batches, sampled_texts, slices, texts
from .op08_quality_rules import View
from .wordhash import FOLD, Powers, words_of

TRAIN_DOCS = 4_000
HASHED = 1 << 14
#: Hashed tokens, and how varied the words are.
WIDTH = HASHED + 11
STEPS, RATE, SHRINK = 150, 0.05, 1e-4
SLICE_CHARS = 1_000_000
ROUNDS = 200
KEPT_FROM = 0.5
GOOD, BAD, SILENT = 1, 0, 2
MISTAKE, BELIEF = 0.01, 0.2
VARIETY_WORDS = 1000
MARKED = re.compile(r"[^\w\s]{2,}(?!\S)")
BARE = re.compile(r"(?<!\S)[^\w\s]+(?!\S)")
NOT_MARKS = bytes(b for b in range(256) if not 33 <= b <= 126 or chr(b).isalnum())
NOT_UPPER = bytes(b for b in range(256) if not 65 <= b <= 90)
ENDS = frozenset(".?!\"'")


def flag(bad: bool) -> int:
    return BAD if bad else SILENT


def marks(v: View) -> int:
    """ASCII characters that are visible and neither letters nor digits."""
    return len(v.raw.translate(None, NOT_MARKS))


def marked_words(v: View) -> int:
    return len(MARKED.findall(v.text))


def bare_words(v: View) -> int:
    """Words without a letter or digit."""
    return len(BARE.findall(v.text))


def different(v: View) -> tuple[int, int]:
    """Distinct words of each thousand, added up, and all words: the share does
    not fall with the length of a text."""
    parts = range(0, v.n_words, VARIETY_WORDS)
    return sum(len(set(v.words[at : at + VARIETY_WORDS])) for at in parts), v.n_words


def _variety(v: View) -> int:
    distinct, seen = different(v)
    return flag(seen >= 30 and 5 * distinct < seen)


def _shouting(v: View) -> int:
    upper = len(v.raw.translate(None, NOT_UPPER))
    return flag(v.n_words >= 10 and 2 * upper > v.word_chars)


def _prose(v: View) -> int:
    distinct, seen = different(v)
    closed = sum(line.rstrip()[-1:] in ENDS for line in v.lines)
    varied = seen >= 50 and 10 * distinct > 4 * seen
    plain = 5 * marks(v) <= v.word_chars and 50 * bare_words(v) <= v.n_words
    return GOOD if varied and plain and 10 * closed >= 8 * len(v.lines) else SILENT


#: Several look at one defect, each in its own way.
LABELLERS: dict[str, Callable[[View], int]] = {
    "symbols": lambda v: flag(10 * v.n_symbols > v.n_words),
    # A marked word has two marks at least, so most texts need not be searched.
    "marked_words": lambda v: flag(v.n_words >= 10 and 5 * marks(v) > 2 * v.n_words and 5 * marked_words(v) > v.n_words),
    "bare_words": lambda v: flag(v.n_words >= 10 and 12 * bare_words(v) > v.n_words),
    "marks": lambda v: flag(v.n_words >= 10 and 5 * marks(v) > v.word_chars),
    "repeats": lambda v: flag(v.n_words >= 20 and 10 * v.n_repeat_words > 4 * v.n_words),
    "lines": lambda v: flag(len(v.lines) > 3 and 2 * v.n_dup_lines > len(v.lines)),
    "variety": _variety,
    "word_length": lambda v: flag(v.n_words >= 20 and not 3 * v.n_words <= v.word_chars <= 14 * v.n_words),
    "shouting": _shouting,
    "prose": _prose,
}


def pattern_of(text: str) -> str:
    view = View(text)
    return "".join(str(f(view)) for f in LABELLERS.values())


def pattern_counts(docs: DataFrame) -> dict[str, int]:
    """Documents by pattern of votes; partial counts per task."""

    def make():
        counts: Counter = Counter()

        def step(rows):
            counts.update(map(pattern_of, rows["text"]))
            return ()

        def finish():
            yield {"pattern": list(counts), "n": list(counts.values())}

        step.finish = finish
        return step

    partial = map_batches(texts(docs).select("text"), make, "pattern string, n bigint")
    return {r["pattern"]: r["n"] for r in partial.groupBy("pattern").agg(F.sum("n").alias("n")).collect()}


def estimate(
    counts: dict[str, int], rounds: int = ROUNDS, belief: float = BELIEF
) -> tuple[dict[str, float], float, np.ndarray]:
    """Posterior of "good" for each pattern, the share of good documents, and
    the vote probabilities (labeller, class, vote).

    Heuristics find different defects, so they seldom agree; without a prior the
    most frequent defect alone would become the bad class. The prior says that a
    heuristic is wrong about a text in ``MISTAKE`` of the cases, and counts as
    much as ``belief`` times the documents. Starts from whether anything
    complains; one count per cell keeps every probability positive.
    """
    patterns = sorted(counts)
    if not patterns:
        return {}, 0.5, np.full((len(LABELLERS), 2, 3), 1 / 3)
    weight = np.array([counts[p] for p in patterns], float)
    votes = np.array([[int(v) for v in p] for p in patterns])
    hot = np.eye(3)[votes]  # pattern, labeller, vote
    good, bad = hot[:, :, GOOD].sum(axis=1), hot[:, :, BAD].sum(axis=1)
    chance = (good + 1) / (good + bad + 2) if not belief else np.where(bad > 0, 0.1, 0.9)
    prior = np.ones((2, 3))
    prior[GOOD, BAD] += belief * weight.sum() * MISTAKE
    prior[GOOD, [GOOD, SILENT]] += belief * weight.sum() * (1 - MISTAKE) / 2
    prior[BAD, GOOD] += belief * weight.sum() * MISTAKE
    prior[BAD, [BAD, SILENT]] += belief * weight.sum() * (1 - MISTAKE) / 2
    for _ in range(rounds):
        by_class = np.stack([weight * (1 - chance), weight * chance])
        share = by_class[1].sum() / weight.sum()
        cells = np.einsum("cp,plv->lcv", by_class, hot) + prior
        given = cells / cells.sum(axis=2, keepdims=True)
        logs = np.einsum("plv,lcv->pc", hot, np.log(given)) + np.log(np.clip([1 - share, share], 1e-9, 1))
        new = 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -700, 700)))
        if np.abs(new - chance).max() < 1e-9:
            break
        chance = new
    return dict(zip(patterns, chance.tolist(), strict=True)), float(share), given


# ---- the scorer

#: Runs of visible ASCII characters that are neither letters nor digits.
MARK_RUNS = np.array([b if 33 <= b <= 126 and not chr(b).isalnum() else 0 for b in range(256)], np.uint8)
MARK_SALT = np.uint64(0x5851F42D4C957F2D)


def features_of(batch: list[str], held: Powers) -> tuple[np.ndarray, np.ndarray]:
    """What the scorer sees of each text, as numbers below ``WIDTH`` with the
    places where each text's begin: its hashed words, its hashed runs of marks,
    and how varied its words are, in tenths."""
    docs = np.arange(len(batch))
    parts = []
    for fold, salt in ((FOLD, np.uint64(0)), (MARK_RUNS, MARK_SALT)):
        found = words_of(batch, held, fold)
        doc = np.repeat(docs, np.diff(found.first))
        parts.append(doc * WIDTH + ((found.hash ^ salt) % np.uint64(HASHED)).astype(np.int64))
        if fold is FOLD:
            order = np.lexsort((found.hash, doc))
            first = np.ones(len(order), bool)
            first[1:] = (np.diff(doc[order]) != 0) | (found.hash[order][1:] != found.hash[order][:-1])
            different_words = np.bincount(doc[order][first], minlength=len(batch))
            parts.append(docs * WIDTH + HASHED + 10 * different_words // np.maximum(1, np.diff(found.first)))
    doc, feature = np.divmod(np.unique(np.concatenate(parts)), WIDTH)
    return feature, np.searchsorted(doc, np.arange(len(batch) + 1))


@dataclass(frozen=True)
class Scorer:
    """A logistic model over the features."""

    weight: np.ndarray
    start: float

    def __call__(self, feature: np.ndarray, first: np.ndarray) -> np.ndarray:
        # Every text has at least its variety, so no part is empty.
        margin = self.start + (np.add.reduceat(self.weight[feature], first[:-1]) if len(first) > 1 else 0)
        return 1 / (1 + np.exp(-np.clip(margin, -500, 500)))


def fitted(feature: np.ndarray, first: np.ndarray, chance: np.ndarray, copies: np.ndarray) -> Scorer:
    """Weights for the cross entropy with the posteriors ``chance``, by ``STEPS``
    full steps of momentum with a scale of their own for each weight."""
    row = np.repeat(np.arange(len(chance)), np.diff(first))
    model = Scorer(np.zeros(WIDTH), float(np.log((chance @ copies + 1) / ((1 - chance) @ copies + 1))))
    total = copies.sum()
    mean, square, mean_start, square_start = np.zeros(WIDTH), np.zeros(WIDTH), 0.0, 0.0
    for step in range(1, STEPS + 1):
        error = (model(feature, first) - chance) * copies / total
        slope = np.bincount(feature, error[row], WIDTH) + SHRINK * model.weight
        slope_start = error.sum()
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope**2
        mean_start, square_start = 0.9 * mean_start + 0.1 * slope_start, 0.99 * square_start + 0.01 * slope_start**2
        scale = RATE * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
        model = Scorer(
            model.weight - scale * mean / (np.sqrt(square) + 1e-9),
            model.start - scale * mean_start / (np.sqrt(square_start) + 1e-9),
        )
    return model


def training_rows(docs: DataFrame, posterior: dict[str, float], train_docs: int) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Different texts of about ``train_docs`` documents from all parts of the
    table, the posterior of each and how many documents it stands for."""

    def make():
        held = Powers()

        def step(rows):
            for some in slices(rows["text"], SLICE_CHARS):
                feature, first = features_of(rows["text"][some], held)
                yield {
                    "features": [feature[a:b].astype("<i4").tobytes() for a, b in zip(first[:-1], first[1:], strict=True)],
                    "chance": [posterior.get(pattern_of(t), 0.5) for t in rows["text"][some]],
                    "copies": rows["copies"][some],
                }

        return step

    found = map_batches(sampled_texts(docs, train_docs), make, "features binary, chance double, copies bigint")
    # Equal features and chances are one row, and the order does not depend on partitions.
    one = found.groupBy("features", "chance").agg(F.sum("copies").alias("copies")).collect()
    one.sort(key=lambda r: (bytes(r["features"]), r["chance"]))
    return [bytes(r["features"]) for r in one], np.array([r["chance"] for r in one]), np.array([float(r["copies"]) for r in one])


def train(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> Scorer:
    posterior, share, _ = estimate(pattern_counts(docs))
    packed, chance, copies = training_rows(docs, posterior, train_docs)
    if not packed or chance.max() < KEPT_FROM or chance.min() >= KEPT_FROM:
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Scorer(np.zeros(WIDTH), float(np.log(share / (1 - share))))
    first = np.append(0, np.cumsum([len(p) // 4 for p in packed]))
    return fitted(np.frombuffer(b"".join(packed), "<i4"), first, chance, copies)


def scored(docs: DataFrame, model: Scorer) -> DataFrame:
    """Per row: doc_id, score (chance of good quality) and kept."""

    def make():
        held = Powers()

        def step(rows):
            for some in slices(rows["text"], SLICE_CHARS):
                score = np.round(model(*features_of(rows["text"][some], held)), 6)
                yield {"doc_id": rows["doc_id"][some], "score": score, "kept": score >= KEPT_FROM}

        return step

    return map_batches(texts(docs), make, "doc_id bigint, score double, kept boolean")


def quality_scores(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """``scored`` by a model of the same documents."""
    return scored(docs, train(docs, train_docs))


def op6_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    return quality_scores(documents(spark, sf))
