"""Benchmark decontamination by latent semantic retrieval.

The terms are the words of the benchmark items. Their document frequencies are
counted over all documents; passages are TF-IDF vectors over the terms. A
randomised singular value decomposition of the passages (all items, and all
passages of all documents, whose partial products are summed on the executors)
gives term directions. Every document is then cut into blocks of
``STEP`` words, and every window of blocks that an item of some length fits
into is compared with the items of that length: the cosine of the projections
and the share of the item's mass found in the window select candidates. So that
no leak depends on what the directions tell apart, every window that holds
enough of an item's rarest words is a candidate as well; a window without them
lacks too many of the item's words for a finding. Candidates whose window lacks
too many of all of the item's words are dropped.

A candidate is checked on its words: the longest common subsequence must hold
``COPY`` of the item's words, or ``PARAPHRASE`` of them if the item's answer,
its last sentence, stands there as well. Items told in another order share few
words in a row: for a window whose cosine is at least ``ALIKE``, ``REWORDED`` of
the words in order are enough besides the answer.

The items are the stated queries: they are taken in blocks of ``BLOCK_ITEMS``,
and each block meets all documents once. Items with fewer than ``MIN_WORDS``
words are found as exact sequences of words.

Null and empty texts are clean; very long texts are searched window by window;
of windows that hold the same share of an item the first is given; repeated
rows are each searched; an empty table or benchmark gives no findings; other
columns pass unread.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from corpuslab.session import scratch_path, via_table

from .common import bounded_batches, documents, map_batches, texts
from .wordhash import Lookup, Powers, Words, words_of

STEP = 16
RANK = 64
OVERSAMPLE = 10
POWER_ROUNDS = 2
PASSAGE = 64
#: Terms whose partial products of all tasks meet in one group.
TERM_BLOCK = 32
#: The most frequent terms of a task, whose weights are multiplied as a matrix.
OFTEN = 512
BLOCK_ITEMS = 2_000
MIN_WORDS = 5
COSINE = 0.55
MASS = 0.5
COPY, PARAPHRASE, ANSWER = 0.8, 0.6, 0.8
#: Rarest words of an item beyond those that a finding may lack.
SPARE = 3
#: A reworded item: how like it a window must look, and the share of its words in order besides the answer.
ALIKE, REWORDED = 0.75, 0.3
SLICE = 100
CHECKED = 20_000
SENTENCES = re.compile(r"[.?!\n]+")


@dataclass(frozen=True)
class Items:
    """One block of the benchmark: ids, word hashes of each text and answer."""

    ids: list
    words: list[np.ndarray]
    answers: list[np.ndarray]
    terms: np.ndarray
    short_ids: list
    short: list[np.ndarray]


@dataclass(frozen=True)
class Index:
    """What a search needs: the documents that hold each term, its direction
    (scaled by its inverse document frequency), and the items by window length."""

    items: Items
    counts: np.ndarray
    directions: np.ndarray
    projected: np.ndarray
    by_width: dict


def answer_of(text: str) -> str:
    """The last sentence, or the last quarter of the words of a single one."""
    sentences = [s for s in SENTENCES.split(text) if s.strip()]
    if len(sentences) > 1:
        return sentences[-1]
    words = text.split()
    return " ".join(words[-max(1, len(words) // 4) :])


def items_of(rows: list) -> Items | None:
    held = Powers()
    kept, short = [], []
    for row in rows:
        words = words_of([row["text"] or ""], held).hash
        if len(words) >= MIN_WORDS:
            kept.append((row["item_id"], words, words_of([answer_of(row["text"])], held).hash))
        elif len(words):
            short.append((row["item_id"], words))
    if not kept and not short:
        return None
    ids, words, answers = (list(c) for c in zip(*kept, strict=True)) if kept else ([], [], [])
    terms = np.unique(np.concatenate(words)) if kept else np.zeros(0, np.uint64)
    return Items(ids, words, answers, terms, [i for i, _ in short], [w for _, w in short])


def blocks_of(benchmark: DataFrame, size: int = BLOCK_ITEMS) -> Iterator[Items]:
    """The benchmark in blocks of about ``size`` items, one collected at a time.
    Items are numbered once, so that rows with one id spread over the blocks."""
    parts = max(1, -(-benchmark.count() // size))
    rows = benchmark.select("item_id", "text")
    if parts > 1:
        rows = via_table(rows.withColumn("row", F.monotonically_increasing_id()), "benchmark-items")
    for part in range(parts):
        own = rows.filter(F.pmod(F.xxhash64("row"), F.lit(parts)) == part) if parts > 1 else rows
        items = items_of(own.orderBy("item_id", "text").collect())
        if items:
            yield items


def document_frequencies(docs: DataFrame, terms: np.ndarray) -> tuple[np.ndarray, int]:
    """Documents that hold each term, and all documents; one partial row per
    term and task, and the benchmark's terms bound what is collected."""
    size = len(terms)
    lookup = Lookup(terms, size)

    def make():
        held, counts = Powers(), np.zeros(size + 1, np.int64)

        def step(rows):
            for at in range(0, len(rows["text"]), SLICE):
                words = words_of(rows["text"][at : at + SLICE], held)
                docs_here = len(words.first) - 1
                seen = np.zeros((docs_here, size + 1), bool)
                seen[np.repeat(np.arange(docs_here), np.diff(words.first)), lookup(words.hash)] = True
                counts[:size] += seen[:, :size].sum(axis=0)
                counts[size] += docs_here
            return ()

        def finish():
            seen = np.flatnonzero(counts)
            yield {"term": seen, "n": counts[seen]}

        step.finish = finish
        return step

    partial = map_batches(texts(docs).select("text"), make, "term int, n bigint")
    total = np.zeros(size + 1, np.int64)
    for row in partial.groupBy("term").agg(F.sum("n").alias("n")).collect():
        total[row["term"]] = row["n"]
    return total[:size], int(total[size])


def passages(docs: DataFrame, items: Items, idf: np.ndarray, n_docs: int) -> DataFrame:
    """Rows of the TF-IDF matrix: term numbers and weights. All items, each of
    unit length, and all passages of ``PASSAGE`` words of all documents. The
    passages of a document weigh the same, all documents weigh the same, and
    together they weigh as much as the items, which keeps the directions on
    what tells the items apart."""
    size = len(items.terms)
    lookup = Lookup(items.terms, size)

    def row(numbers):
        term, count = np.unique(numbers[numbers < size], return_counts=True)
        weight = count * idf[term]
        length = np.linalg.norm(weight)
        return (term.tolist(), (weight / length).tolist()) if length > 0 else None

    def make():
        held = Powers()

        def step(rows):
            for at in range(0, len(rows["text"]), SLICE):
                words = words_of(rows["text"][at : at + SLICE], held)
                counts = np.diff(words.first)
                n_passages = -(-counts // PASSAGE)
                doc = np.repeat(np.arange(len(counts)), counts)
                passage = (np.cumsum(n_passages) - n_passages)[doc] + (np.arange(len(doc)) - words.first[doc]) // PASSAGE
                number = lookup(words.hash)
                known = number < size
                key, count = np.unique(passage[known] * size + number[known], return_counts=True)
                if not len(key):
                    continue
                passage, term = np.divmod(key, size)
                weight = count * idf[term]
                first = np.flatnonzero(np.diff(passage, prepend=-1))
                share = len(items.ids) / n_docs / np.repeat(n_passages, n_passages)[passage[first]]
                scale = np.sqrt(share / np.add.reduceat(weight * weight, first))
                weight = (weight * np.repeat(scale, np.diff(first, append=len(key)))).astype(np.float32)
                ends = pa.array(np.append(first, len(key)), pa.int32())
                columns = {"term": pa.array(term, pa.int32()), "weight": pa.array(weight, pa.float32())}
                yield {name: pa.ListArray.from_arrays(ends, values) for name, values in columns.items()}

        return step

    spark = docs.sparkSession
    schema = "term array<int>, weight array<float>"
    every = map_batches(texts(docs).select("text"), make, schema)
    own = [r for r in (row(lookup(w)) for w in items.words) if r]
    return every.unionByName(spark.createDataFrame(own, schema).coalesce(1))


def product(matrix: DataFrame, basis: np.ndarray) -> np.ndarray:
    """transpose(A) A ``basis`` for the rows of ``matrix``: a partial product per
    task, summed on the executors by blocks of terms. Few terms make up most of
    the weights: the columns of the ``OFTEN`` most frequent ones are multiplied
    as a matrix, the others weight by weight."""
    size, width = basis.shape
    basis = basis.astype(np.float32)

    def partial(batches):
        total, often, column = np.zeros((size, width)), None, None
        for batch in batches:
            terms, weights = batch.column("term"), batch.column("weight")
            term, weight = terms.flatten().to_numpy(), weights.flatten().to_numpy().astype(np.float32, copy=False)
            counts = np.diff(terms.offsets.to_numpy())
            row = np.repeat(np.arange(len(counts)), counts)
            if not len(term):
                continue
            if often is None:
                often = np.argsort(-np.bincount(term, minlength=size), kind="stable")[:OFTEN]
                column = np.full(size, -1)
                column[often] = np.arange(len(often))
            place = column[term]
            dense = place >= 0
            block = np.zeros((len(counts), len(often)), np.float32)
            block[row[dense], place[dense]] = weight[dense]
            projected = block @ basis[often]
            row, term, weight = row[~dense], term[~dense], weight[~dense, None]
            if len(term):
                first = np.flatnonzero(np.diff(row, prepend=-1))
                projected[row[first]] += np.add.reduceat(basis[term] * weight, first)
                order = np.argsort(term, kind="stable")
                first = np.flatnonzero(np.diff(term[order], prepend=-1))
                total[term[order[first]]] += np.add.reduceat(projected[row[order]] * weight[order], first)
            total[often] += block.T @ projected
        places = range(0, size, TERM_BLOCK)
        blocks = [total[at : at + TERM_BLOCK].tobytes() for at in places]
        yield pa.RecordBatch.from_arrays([pa.array(places, pa.int32()), pa.array(blocks, pa.binary())], ["at", "part"])

    def summed(key, frame):
        total = sum(np.frombuffer(p) for p in frame["part"])
        frame = frame.iloc[:1].copy()
        frame["part"] = [total.tobytes()]
        return frame

    schema = "at int, part binary"
    rows = matrix.mapInArrow(partial, schema).groupBy("at").applyInPandas(summed, schema).collect()
    out = np.zeros((size, width))
    for r in rows:
        block = np.frombuffer(r["part"]).reshape(-1, width)
        out[r["at"] : r["at"] + len(block)] = block
    return out


def term_directions(matrix: DataFrame, size: int, rank: int = RANK) -> np.ndarray:
    """Right singular vectors of ``matrix`` (one row per term) by randomised
    subspace iteration."""
    width = min(rank + OVERSAMPLE, size)
    basis = np.linalg.qr(np.random.default_rng(7).standard_normal((size, width)))[0]
    for _ in range(POWER_ROUNDS):
        basis = np.linalg.qr(product(matrix, basis))[0]
    small = basis.T @ product(matrix, basis)
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    return basis @ vectors[:, np.argsort(-values)[:rank]]


def widths(longest: int):
    """Window lengths in words, each 4/3 or 3/2 of the one before."""
    at = 2 * STEP
    while True:
        yield from (at, at * 3 // 2)
        if at * 3 // 2 >= longest:
            return
        at *= 2


def fit(docs: DataFrame, items: Items, rank: int = RANK) -> Index:
    if not items.ids:
        return Index(items, np.zeros(0, np.int64), np.zeros((1, 1), np.float32), np.zeros((0, 1)), {})
    counts, total = document_frequencies(docs, items.terms)
    idf = np.log((total + 1) / (counts + 1)) + 1e-3
    matrix = via_table(passages(docs, items, idf, max(1, total)), "passages")
    vectors = term_directions(matrix, len(items.terms), rank)
    directions = np.vstack([vectors * idf[:, None], np.zeros((1, vectors.shape[1]))]).astype(np.float32)
    lookup = Lookup(items.terms, len(items.terms))
    projected = np.array([directions[lookup(w)].sum(axis=0) for w in items.words])
    by_width: dict[int, list[int]] = {}
    for i, words in enumerate(items.words):
        needed = 1.2 * len(words) + STEP
        by_width.setdefault(next(w for w in widths(int(needed) + 1) if w >= needed), []).append(i)
    return Index(items, counts, directions, projected, by_width)


# ---- search


def common_length(masks: dict, size: int, words: list) -> int:
    """Longest common subsequence of a text of ``size`` words, given as the bits
    of each word's places, with ``words``; one step per word."""
    full = (1 << size) - 1
    rest = full
    for word in words:
        places = masks.get(word)
        if places:
            step = rest & places
            rest = ((rest + step) | (rest - step)) & full
    return size - rest.bit_count()


def masks_of(words: np.ndarray) -> dict:
    out: dict[int, int] = {}
    for i, word in enumerate(words.tolist()):
        out[word] = out.get(word, 0) | 1 << i
    return out


class Searcher:
    def __init__(self, index: Index):
        self.index, self.held = index, Powers()
        items = index.items
        self.short_firsts = np.array([w[0] for w in items.short], np.uint64)
        if not items.ids:
            return
        self.lookup = Lookup(items.terms, len(items.terms))
        self.texts = [(masks_of(w), len(w)) for w in items.words]
        self.answers = [(masks_of(w), len(w)) for w in items.answers]
        sizes = np.array([len(w) for w in items.words])
        self.least = np.ceil(PARAPHRASE * sizes - 1e-9).astype(np.int64)
        self.least_alike = np.ceil(REWORDED * sizes - 1e-9).astype(np.int64)
        self.times = np.zeros((len(sizes), len(items.terms) + 1), np.min_scalar_type(int(sizes.max())))
        for i, words in enumerate(items.words):
            term, count = np.unique(self.lookup(words), return_counts=True)
            self.times[i, term] = count
        lengths = np.maximum(np.linalg.norm(index.projected, axis=1), 1e-9)
        self.unit = (index.projected / lengths[:, None]).astype(np.float32)
        self.mass = (MASS * lengths).astype(np.float32)
        self.rare_words(sizes)

    def rare_words(self, sizes: np.ndarray) -> None:
        """For each term the items that have it among their rarest words, and
        how often; of these words a window with a finding holds ``enough``."""
        self.enough = np.zeros(len(sizes), np.int64)
        term, item, weight = [], [], []
        for i, (size, least) in enumerate(zip(sizes.tolist(), self.least.tolist(), strict=True)):
            own = np.flatnonzero(self.times[i])
            own = own[np.argsort(self.index.counts[own], kind="stable")]
            held = np.cumsum(self.times[i, own], dtype=np.int64)
            last = int(np.searchsorted(held, size - least + min(SPARE, least)))
            self.enough[i] = held[last] - (size - least)
            term.append(own[: last + 1])
            item.append(np.full(last + 1, i))
            weight.append(self.times[i, own[: last + 1]].astype(np.int64))
        term, item, weight = (np.concatenate(c) for c in (term, item, weight))
        order = np.argsort(term, kind="stable")
        self.rare_item, self.rare_weight = item[order], weight[order]
        # One more, empty, for the missing term.
        self.rare_first = np.searchsorted(term[order], np.arange(len(self.index.items.terms) + 2))

    def __call__(self, batch: list[str]) -> list[tuple[int, int, float, int]]:
        """(number of the text, number of the item, share of the item's words,
        first word of the window) of each finding, the best window of a pair."""
        words = words_of(batch, self.held)
        best: dict[tuple[int, int], tuple[float, int]] = {}
        for doc, item, begin, low, high, alike in self.candidates(words) if self.index.items.ids else ():
            inside = words.hash[low:high].tolist()
            masks, size = self.texts[item]
            share = common_length(masks, size, inside) / size
            enough = REWORDED if alike else PARAPHRASE
            if share >= COPY or share >= enough and self.answered(item, inside):
                known = best.get((doc, item), (0.0, -begin))
                best[doc, item] = max(known, (share, -begin))
        found = [(doc, item, share, -at) for (doc, item), (share, at) in sorted(best.items())]
        return found + self.short_items(words)

    def short_items(self, words: Words) -> list[tuple[int, int, float, int]]:
        """Items of fewer than ``MIN_WORDS`` words, as exact sequences; numbered
        after the others, each with the first place in a text."""
        out: dict[tuple[int, int], int] = {}
        for at in np.flatnonzero(np.isin(words.hash, self.short_firsts)).tolist() if len(self.short_firsts) else ():
            doc = int(np.searchsorted(words.first, at, side="right")) - 1
            for number in np.flatnonzero(self.short_firsts == words.hash[at]).tolist():
                own = self.index.items.short[number]
                inside = words.hash[at : min(at + len(own), words.first[doc + 1])]
                if len(inside) == len(own) and (inside == own).all():
                    out.setdefault((doc, len(self.index.items.ids) + number), at - int(words.first[doc]))
        return [(doc, item, 1.0, first) for (doc, item), first in sorted(out.items())]

    def answered(self, item: int, inside: list) -> bool:
        masks, size = self.answers[item]
        return common_length(masks, size, inside) >= ANSWER * size

    def candidates(self, words: Words):
        """(text, item, first word in the text, range of words to compare) of
        windows that look like an item and hold enough of its words."""
        counts = np.diff(words.first)
        if not counts.sum():
            return
        missing = len(self.index.items.terms)
        ids = np.append(self.lookup(words.hash), missing)
        n_blocks = -(-counts // STEP)
        block_end = np.cumsum(n_blocks)
        doc = np.repeat(np.arange(len(counts)), n_blocks)
        within = np.arange(len(doc)) - (block_end - n_blocks)[doc]
        begin, doc_end = words.first[doc] + within * STEP, words.first[doc + 1]
        sums = np.zeros((len(doc) + 1, self.index.directions.shape[1]))
        sums[1:] = self.block_sums(ids, begin, doc_end)
        np.cumsum(sums, axis=0, out=sums)
        block = np.arange(len(doc))
        rare = self.rare_blocks(ids[:-1], np.repeat(block, np.minimum(begin + STEP, doc_end) - begin), len(doc))
        n_items = len(self.texts)
        for width, items in self.index.by_width.items():
            size = -(-width // STEP)
            end = np.minimum(block + size, block_end[doc])
            at = np.flatnonzero((end - block == size) | (within == 0))
            window = (sums[end[at]] - sums[at]).astype(np.float32)
            dots = window @ self.unit[items].T
            lengths = np.linalg.norm(window, axis=1)
            row, column = np.nonzero((dots >= COSINE * lengths[:, None]) & (dots >= self.mass[items]))
            pairs = at[row] * n_items + np.array(items)[column]
            looks = np.sort(pairs[dots[row, column] >= ALIKE * lengths[row]])
            pairs = np.union1d(pairs, self.rare_windows(rare, items, size, block_end[doc], within))
            for some in range(0, len(pairs), CHECKED):
                part = pairs[some : some + CHECKED]
                place, item = np.divmod(part, n_items)
                alike = np.isin(part, looks, assume_unique=True)
                low = np.maximum(words.first[doc[place]], begin[place] - STEP)
                high = np.minimum(doc_end[place], begin[place] + (size + 1) * STEP)
                kept = self.can_hold(ids, item, low, high, (size + 2) * STEP, np.where(alike, self.least_alike[item], self.least[item]))
                first = begin[place] - words.first[doc[place]]
                yield from zip(*(c[kept].tolist() for c in (doc[place], item, first, low, high, alike)), strict=True)

    def rare_blocks(self, ids: np.ndarray, block: np.ndarray, n_blocks: int):
        """Items times ``n_blocks`` plus block, ordered, for each item and block
        that holds any of its rarest words, and a running sum of how many."""
        each = self.rare_first[ids + 1] - self.rare_first[ids]
        word = np.repeat(np.arange(len(ids)), each)
        place = np.arange(len(word)) - (np.cumsum(each) - each - self.rare_first[ids])[word]
        # A word counts once in a block.
        place, block = np.divmod(np.unique(place * n_blocks + block[word]), n_blocks)
        key = self.rare_item[place] * n_blocks + block
        order = np.argsort(key, kind="stable")
        key, weight = key[order], self.rare_weight[place][order]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        return key[first], np.append(0, np.cumsum(np.add.reduceat(weight, first))) if len(key) else np.zeros(1, np.int64)

    def rare_windows(self, rare, items: list, size: int, block_end: np.ndarray, within: np.ndarray) -> np.ndarray:
        """Blocks times the number of items plus item, of all windows of ``size``
        blocks that hold enough of the rarest words of one of ``items``."""
        key, total = rare
        n_blocks, n_items = len(within), len(self.texts)

        def held(item, begin):
            ends = np.minimum(begin + size, block_end[begin])
            low, high = (np.searchsorted(key, item * n_blocks + at) for at in (begin, ends))
            return total[high] - total[low] >= self.enough[item]

        wanted = np.zeros(n_items, bool)
        wanted[items] = True
        item, block = np.divmod(key, n_blocks)
        own = np.flatnonzero(wanted[item])
        # The first block with such a word, in any window with enough of them.
        own = own[held(item[own], block[own])]
        begin = block[own][:, None] - np.arange(size)
        inside = begin >= (block - within[block])[own][:, None]
        begin, item = begin[inside], np.broadcast_to(item[own][:, None], inside.shape)[inside]
        begin, item = np.divmod(np.unique(begin * n_items + item), n_items)
        # The windows of the projections: whole ones, and the first of a short text.
        kept = (begin + size <= block_end[begin]) | (within[begin] == 0)
        begin, item = begin[kept], item[kept]
        kept = held(item, begin)
        return begin[kept] * n_items + item[kept]

    def block_sums(self, ids: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Projection of each block of words; ``ids`` ends with the missing term,
        whose direction is zero."""
        last = len(ids) - 1
        total = np.zeros((len(begin), self.index.directions.shape[1]), np.float32)
        for step in range(STEP):
            at = begin + step
            total += self.index.directions[ids[np.where(at < end, at, last)]]
        return total

    def can_hold(self, ids, item, low, high, width: int, least: np.ndarray) -> np.ndarray:
        """Whether the words of an item that occur in ids[low:high] at all, however
        often the item has them, are enough for a finding."""
        at = low[:, None] + np.arange(width)
        inside = np.sort(ids[np.where(at < high[:, None], at, len(ids) - 1)], axis=1)
        inside[:, 1:][inside[:, 1:] == inside[:, :-1]] = len(self.index.items.terms)
        return self.times[item[:, None], inside].sum(axis=1, dtype=np.int64) >= least


FINDINGS = "doc_id bigint, item_id bigint, share double, first_word bigint"


def findings(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, share of the item's words found in order, and the first
    word of the window, for every document and item that it leaks. The findings
    of a block are written before the next block is taken up."""
    spark = docs.sparkSession
    path = scratch_path(spark, "leaks")
    spark.createDataFrame([], FINDINGS).write.parquet(path)
    for items in blocks_of(benchmark):
        index = fit(docs, items)
        every = [*items.ids, *items.short_ids]

        def make(index=index, every=every):
            search = Searcher(index)

            def step(rows):
                for at in range(0, len(rows["text"]), SLICE):
                    found = search(rows["text"][at : at + SLICE])
                    yield {
                        "doc_id": [rows["doc_id"][at + doc] for doc, *_ in found],
                        "item_id": [every[item] for _, item, *_ in found],
                        "share": [share for *_, share, _ in found],
                        "first_word": [first for *_, first in found],
                    }

            return step

        map_batches(texts(docs), make, FINDINGS).write.mode("append").parquet(path)
    return spark.read.schema(FINDINGS).parquet(path)


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows that leak no item, with all their columns. What a block leaves
    is written before the next block is taken up."""
    out, first = docs, True
    bounded_batches(docs.sparkSession)
    for items in blocks_of(benchmark):
        index = fit(docs, items)
        out, first = out if first else via_table(out, "leaks-left"), False

        def run(batches, index=index):
            search = Searcher(index)
            for batch in batches:
                column = batch.column(batch.schema.get_field_index("text")).to_pylist()
                keep = np.ones(len(column), bool)
                for at in range(0, len(column), SLICE):
                    found = search([t or "" for t in column[at : at + SLICE]])
                    keep[[at + doc for doc, *_ in found]] = False
                yield batch.filter(pa.array(keep))

        out = out.mapInArrow(run, docs.schema)
    return out


def op9_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return findings(documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet"))
