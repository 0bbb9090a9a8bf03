"""Ranked lexical search, term at a time with a limit on accumulators.

A first pass turns each document into a row of the index: its number of terms,
and which terms of the items it holds how often. Counts over the index give
the weight of every term. In the search pass a task gathers index rows into
blocks, inverts each block into postings with their exact integer scores, and
works through an item's terms from the rarest on. While the scores that the
remaining terms can still add reach the k-th best score known, documents get
an accumulator; from then on only documents that have one are updated, to
their exact score. The k-th best score known is that of the task's earlier
blocks or, if higher, of the partial scores in the block. A task gives its k
best documents of each item; those are ranked first by groups of tasks, then
over all. Nothing is approximate: a document without an accumulator scores
less than k others.

Items are taken in blocks of ``BLOCK_ITEMS``, one after the other: a block is
all that the driver and a worker hold of them.

Null texts have no terms; a document without doc_id counts and is ranked last
among equal scores; repeated rows of either table are documents and items of
their own; equal scores rank by doc_id; items without a term in any document
give no rows, and so do empty tables; long texts are counted in pieces of
bounded size; further columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from corpuslab.session import drop_table, scratch_path, via_table

from .common import documents, map_batches, slices, texts
from .wordhash import Lookup, Powers, words_of

BEST = 10
BLOCK_ITEMS = 2_000
BLOCK_CHARS = 4_000_000
BLOCK_POSTINGS = 2_000_000
BLOCK_ROWS = 1 << 16
SLICE_CHARS = 1 << 20
MERGE_GROUPS = 64
RANKS = "item_id bigint, rank int, doc_id bigint, score bigint"

# The whole numbers of the score.
SCALE = 1_000_000_000
LENGTH_SHARE = 75


@dataclass(frozen=True)
class Items:
    """A block of items: their ids, each one's terms with repeats counted, and
    all their terms by number with a 64-bit hash."""

    ids: list
    terms: list[dict[int, int]]
    hashes: np.ndarray


def terms_of(rows: list) -> Items:
    """Items from (item_id, text) rows."""
    found = words_of([r["text"] or "" for r in rows], Powers())
    hashes, numbers = np.unique(found.hash, return_inverse=True)
    terms = [
        dict(Counter(numbers[a:b].tolist())) for a, b in zip(found.first[:-1], found.first[1:], strict=True)
    ]
    return Items([r["item_id"] for r in rows], terms, hashes)


def blocks_of(items: DataFrame) -> Iterator[Items]:
    """The items in blocks of bounded size, one collected at a time."""
    items = items.select("item_id", "text")
    size = items.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("c")).first()
    blocks = max(1, -(-size["n"] // BLOCK_ITEMS), -(-size["c"] // BLOCK_CHARS))
    if blocks > 1:
        # Rows are numbered once, so that equal rows spread over the blocks too.
        numbered = via_table(items.withColumn("row", F.monotonically_increasing_id()), "search-items")
        for block in range(blocks):
            yield terms_of(numbered.filter(F.pmod(F.xxhash64("row"), F.lit(blocks)) == block).collect())
    elif size["n"]:
        yield terms_of(items.collect())


def indexed(docs: DataFrame, hashes: np.ndarray) -> DataFrame:
    """Per document: doc_id, n (terms with repeats), and the numbers and counts
    of the terms among ``hashes``, as little-endian 32-bit integers."""

    def make():
        numbers, held = Lookup(hashes, len(hashes)), Powers()

        def step(rows):
            for some in slices(rows["text"], SLICE_CHARS):
                found = words_of(rows["text"][some], held)
                number = numbers(found.hash)
                doc = np.repeat(np.arange(len(found.first) - 1), np.diff(found.first))
                known = number < len(hashes)
                pairs, count = np.unique(doc[known] * (len(hashes) + 1) + number[known], return_counts=True)
                at, term = np.divmod(pairs, len(hashes) + 1)
                ends = np.searchsorted(at, np.arange(len(found.first)))
                term, count = term.astype("<i4"), count.astype("<i4")
                cut = list(zip(ends[:-1], ends[1:], strict=True))
                yield {
                    "doc_id": rows["doc_id"][some],
                    "n": np.diff(found.first),
                    "terms": [term[a:b].tobytes() for a, b in cut],
                    "counts": [count[a:b].tobytes() for a, b in cut],
                }

        return step

    return map_batches(texts(docs), make, "doc_id bigint, n bigint, terms binary, counts binary")


def frequencies(index: DataFrame, size: int) -> np.ndarray:
    """In how many documents each term occurs."""

    def make():
        total = np.zeros(size, np.int64)

        def step(rows):
            total[:] += np.bincount(np.frombuffer(b"".join(rows["terms"]), "<i4"), minlength=size)
            return ()

        def finish():
            seen = np.flatnonzero(total)
            yield {"term": seen, "n": total[seen]}

        step.finish = finish
        return step

    counted = map_batches(index.select("terms"), make, "term int, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    out = np.zeros(size, np.int64)
    for row in counted.collect():  # the terms of a block of items
        out[row["term"]] = row["n"]
    return out


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


class Postings:
    """An inverted block: of each term the places of its documents, ascending,
    what it adds to their scores, and the most that it adds."""

    def __init__(
        self,
        lengths: np.ndarray,
        sizes: np.ndarray,
        terms: np.ndarray,
        counts: np.ndarray,
        weights: np.ndarray,
        n: int,
        total: int,
    ):
        doc = np.repeat(np.arange(len(lengths)), sizes)
        norm = 100 - LENGTH_SHARE + (LENGTH_SHARE * lengths * n) // max(1, total)
        gained = weights[terms] * ((SCALE * counts) // (1000 * counts + 8 * norm[doc]))
        order = np.argsort(terms, kind="stable")
        self.docs, self.gained = doc[order], gained[order]
        self.begin = np.searchsorted(terms[order], np.arange(len(weights) + 1))
        self.most = np.zeros(len(weights), np.int64)
        held = np.flatnonzero(np.diff(self.begin))
        if len(held):
            self.most[held] = np.maximum.reduceat(self.gained, self.begin[held])

    def of(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        some = slice(self.begin[term], self.begin[term + 1])
        return self.docs[some], self.gained[some]


def search_block(
    block: Postings, size: int, terms: list[tuple[int, int]], best: int, known: int
) -> tuple[np.ndarray, np.ndarray]:
    """Places and exact scores of the documents that got an accumulator, given
    (term, repeats) from the rarest on and the k-th best score ``known`` so
    far. All documents that score ``known`` or more, and enough of the block's
    best, are among them."""
    remaining = np.cumsum([repeats * block.most[term] for term, repeats in reversed(terms)])[::-1]
    score = np.zeros(size, np.int64)
    at = 0
    while at < len(terms) and remaining[at] > 0 and remaining[at] >= known:
        docs, gained = block.of(terms[at][0])
        score[docs] += terms[at][1] * gained
        at += 1
        # Partial scores can only be as high as the bound once the best of them is.
        if size > best and at < len(terms) and score.max() > remaining[at]:
            known = max(known, int(np.partition(score, size - best)[size - best]))
    held = np.flatnonzero(score)
    kept = score[held]
    for term, repeats in terms[at:]:
        docs, gained = block.of(term)
        if not len(docs) or not len(held):
            continue
        place = np.minimum(np.searchsorted(docs, held), len(docs) - 1)
        kept = kept + np.where(docs[place] == held, repeats * gained[place], 0)
    return held, kept


def candidates(
    index: DataFrame, items: Items, weights: np.ndarray, holding: np.ndarray, n: int, total: int, best: int
) -> DataFrame:
    """The best documents of each item in each task, with their scores."""
    plans = [sorted(terms.items(), key=lambda t: (holding[t[0]], t[0])) for terms in items.terms]
    ids, width = items.ids, len(weights)

    def make():
        found: list[list[tuple]] = [[] for _ in ids]
        doc_ids, lengths, terms, counts = [], [], [], []
        held = 0

        def search():
            sizes = np.fromiter((len(t) // 4 for t in terms), np.int64, len(terms))
            block = Postings(
                np.array(lengths, np.int64),
                sizes,
                np.frombuffer(b"".join(terms), "<i4"),
                np.frombuffer(b"".join(counts), "<i4").astype(np.int64),
                weights,
                n,
                total,
            )
            here = np.diff(block.begin) > 0
            for item, plan in enumerate(plans):
                top = found[item]
                known = -top[-1][0] if len(top) == best else 0
                places, scores = search_block(block, len(sizes), [t for t in plan if here[t[0]]], best, known)
                if len(places) > best:
                    least = max(known, int(np.partition(scores, len(scores) - best)[len(scores) - best]))
                    some = scores >= least
                    places, scores = places[some], scores[some]
                rows = [(-s, doc_ids[p]) for p, s in zip(places.tolist(), scores.tolist(), strict=True) if s]
                found[item] = sorted([*top, *rows], key=lambda r: (r[0], r[1] is None, r[1] or 0))[:best]
            for part in (doc_ids, lengths, terms, counts):
                part.clear()

        def step(rows):
            nonlocal held
            for row in zip(rows["doc_id"], rows["n"], rows["terms"], rows["counts"], strict=True):
                for part, value in zip((doc_ids, lengths, terms, counts), row, strict=True):
                    part.append(value)
                held += len(row[2]) // 4
                if held >= BLOCK_POSTINGS or len(doc_ids) >= BLOCK_ROWS:
                    search()
                    held = 0
            return ()

        def finish():
            if doc_ids:
                search()
            rows = [(item, ids[item], doc, -score) for item, top in enumerate(found) for score, doc in top]
            if rows:
                yield dict(zip(("item", "item_id", "doc_id", "score"), map(list, zip(*rows, strict=True)), strict=True))

        step.finish = finish
        return step

    used = index.filter(F.octet_length("terms") > 0) if width else index.limit(0)
    return map_batches(used, make, "item int, item_id bigint, doc_id bigint, score bigint")


def ranked(found: DataFrame, best: int) -> DataFrame:
    """The ``best`` rows of each item: first within groups of tasks, then of all."""
    order = (F.desc("score"), F.asc_nulls_last("doc_id"))
    grouped = found.withColumn("group", F.spark_partition_id() % MERGE_GROUPS)
    for keys in (["item", "group"], ["item"]):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        grouped = grouped.withColumn("rank", rank).filter(F.col("rank") <= best)
    return grouped.select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, best: int = BEST) -> DataFrame:
    """item_id, rank, doc_id and score of the ``best`` documents of each item."""
    spark = docs.sparkSession
    ranks = scratch_path(spark, "search-ranks")
    spark.createDataFrame([], RANKS).write.parquet(ranks)
    for block in blocks_of(items):
        path = scratch_path(spark, "search-index")
        indexed(docs, block.hashes).write.parquet(path)
        index = spark.read.parquet(path)
        size = index.agg(F.count(F.when(F.col("n") > 0, 1)).alias("n"), F.sum("n").alias("total")).first()
        holding = frequencies(index, len(block.hashes))
        n, total = size["n"], size["total"] or 0
        weights = np.array([weight(n, h) for h in holding.tolist()], np.int64)
        found = ranked(candidates(index, block, weights, holding, n, total, best), best)
        found.write.mode("append").parquet(ranks)
        drop_table(path)
    return spark.read.schema(RANKS).parquet(ranks)


def op12_lexical_search(spark: SparkSession, sf: str) -> DataFrame:
    return search(documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet"))


OP12_SQL = r"""
WITH folded AS (
    SELECT row_number() OVER () AS doc, doc_id,
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents
), doc_words AS (
    SELECT doc, doc_id, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM folded
), tf AS (
    SELECT doc, doc_id, term, count(*) AS tf FROM doc_words GROUP BY ALL
), lengths AS (
    SELECT doc, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY doc
), totals AS (
    SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM lengths
), asked AS (
    SELECT row_number() OVER () AS item, item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
), item_terms AS (
    SELECT item, item_id, term, count(*) AS repeats FROM asked GROUP BY ALL
), weights AS (
    SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM tf, totals WHERE term IN (SELECT term FROM item_terms) GROUP BY term, docs
), gains AS (
    SELECT tf.doc, tf.doc_id, tf.term, w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // total))) AS gain
    FROM tf JOIN weights USING (term) JOIN lengths USING (doc), totals
), scores AS (
    SELECT item, item_id, doc, doc_id, CAST(sum(repeats * gain) AS BIGINT) AS score
    FROM item_terms JOIN gains USING (term) GROUP BY ALL HAVING sum(repeats * gain) > 0
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scores
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
