"""Periodic runs: stretches of words that repeat with a period at least twice.

Words q apart are equal all along a run of period q and length l, so l - q
neighbouring places match the place q later. For every octave of periods,
P <= q < 2P, a document is cut into overlapping tiles around boundaries that
are closer than the shortest such stretch: each run has a boundary inside.
Tiles whose boundary begins no six words that return within the octave hold no
run and are not made; the others become rows of their own, spread over the
tasks. A tile is solved by itself: two Z-functions, of the words after the
boundary and of the reversed words before it, give for all periods of the
octave how far places match on both sides, up to the reach of the tile. The
first Z-function also tells periods that only repeat a smaller one. Fragments
are shuffled by document and period, and those that overlap are stitched to
whole runs.

Neighbouring tiles that share words travel as one row of at most
``TILE_WORDS`` words (or one tile), so a long document becomes many rows and
its words are stored about once per octave that repeats in it.

Null and empty texts have no runs; rows without doc_id are not changed by the
query's rule; repeated rows are documents of their own; of runs of one length
the first, then the one of the smaller period is the longest; an empty table
gives no rows; columns besides doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from corpuslab.session import via_table

from .common import documents, map_batches, texts

GRAM = 6
TILE_WORDS = 8_192
TASK_ROWS = 4_000
COMPARED = 1 << 20
SMALL = 16

# The shortest run.
MIN_LENGTH = 12
MIN_REPEATS = 2

PREPARED = (
    "key bigint, doc_id bigint, n_words bigint, text string, collapsed string, "
    "octave int, first bigint, words binary, boundaries binary"
)
TILE = ["key", "octave", "first", "words", "boundaries"]
NO_RUNS = hashlib.sha256(b"").hexdigest()


def matches_needed(period: int) -> int:
    """Neighbouring places that must match for the shortest run."""
    return max((MIN_REPEATS - 1) * period, MIN_LENGTH - period)


def spacing(octave: int) -> int:
    """Distance of boundaries: every run of the octave holds one, and in larger
    octaves six words from it on match as well."""
    if octave < SMALL:
        return min(map(matches_needed, range(octave, 2 * octave)))
    return octave - GRAM + 1


def reach(octave: int) -> int:
    """How far from its boundary a tile looks; neighbours' looks overlap."""
    return max(octave, SMALL)


# ---- from a document to tiles


def coded(words: list[bytes]) -> np.ndarray:
    """Equal words have equal numbers."""
    numbers = {word: i for i, word in enumerate(dict.fromkeys(words))}
    return np.fromiter(map(numbers.__getitem__, words), np.int32, len(words))


def grams(codes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the six words from each place on; only a filter, every match is checked."""
    out = np.zeros(len(codes) - GRAM + 1, np.uint64)
    for place in range(GRAM):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += codes[place : place + len(out)].astype(np.uint64) + np.uint64(1)
        out ^= out >> np.uint64(31)
    return out


def boundaries_of(codes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Octaves, and the boundaries whose tiles may hold a run."""
    n = len(codes)
    if n < MIN_LENGTH:
        return
    hashes = grams(codes)
    ordered = np.sort(hashes)
    repeated = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(repeated):
        return
    octave = 1
    while octave < SMALL and octave <= n // MIN_REPEATS:
        step, found = spacing(octave), []
        for period in range(octave, min(2 * octave, len(hashes))):
            hits = np.flatnonzero(hashes[:-period] == hashes[period:])
            at = -(-hits // step) * step
            found.append(at[at < hits + GRAM])
        if any(map(len, found)):
            yield octave, np.unique(np.concatenate(found))
        octave *= 2
    while octave <= n // MIN_REPEATS:
        at = np.arange(0, len(hashes) - octave, spacing(octave))
        at = at[repeated[np.minimum(np.searchsorted(repeated, hashes[at]), len(repeated) - 1)] == hashes[at]]
        if len(at):
            # The padding may match by chance, which only makes a tile more.
            later = np.lib.stride_tricks.sliding_window_view(np.append(hashes, np.zeros(2 * octave, np.uint64)), octave)
            rows = max(1, COMPARED // octave)
            hit = [
                (later[some + octave] == hashes[some][:, None]).any(axis=1)
                for some in (at[i : i + rows] for i in range(0, len(at), rows))
            ]
            at = at[np.concatenate(hit)]
            if len(at):
                yield octave, at
        octave *= 2


def tiles_of(codes: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Octave, first word, words and boundaries (from the first word on) of rows of tiles."""
    for octave, boundaries in boundaries_of(codes):
        before, after = reach(octave), reach(octave) + 2 * octave
        at = 0
        while at < len(boundaries):
            first = max(0, int(boundaries[at]) - before)
            limit = max(int(boundaries[at]) + after, first + TILE_WORDS)
            to = at + 1
            while (
                to < len(boundaries)
                and boundaries[to] - before <= boundaries[to - 1] + after
                and boundaries[to] + after <= limit
            ):
                to += 1
            last = min(len(codes), int(boundaries[to - 1]) + after)
            yield octave, first, codes[first:last], (boundaries[at:to] - first).astype("<i4")
            at = to


def prepared(docs: DataFrame, change: Callable[[int | None, list[bytes]], list[bytes]] | None) -> DataFrame:
    """A row per document, and a row per row of tiles. Documents without tiles
    are finished: they carry the digest of their words, the others their words."""

    def make():
        def step(rows):
            for key, doc_id, text in zip(rows["key"], rows["doc_id"], rows["text"], strict=True):
                words = text.encode().split()  # bytes split at the six ASCII spaces only
                if change is not None:
                    words = change(doc_id, words)
                joined = b" ".join(words)
                tiles = 0
                for octave, first, codes, boundaries in tiles_of(coded(words)):
                    tiles += 1
                    yield row(key, octave=octave, first=first, words=codes.tobytes(), boundaries=boundaries.tobytes())
                done = hashlib.sha256(joined).hexdigest() if not tiles else None
                yield row(key, doc_id, len(words), joined.decode() if tiles else None, done)

        def row(key, doc_id=None, n_words=None, text=None, collapsed=None, octave=None, first=None, words=None, boundaries=None):
            return {
                "key": [key], "doc_id": [doc_id], "n_words": [n_words], "text": [text], "collapsed": [collapsed],
                "octave": [octave], "first": [first], "words": [words], "boundaries": [boundaries],
            }

        return step

    keyed = texts(docs, F.monotonically_increasing_id().alias("key"))
    return map_batches(keyed, gathered(make), PREPARED)


def gathered(make: Callable) -> Callable:
    """The rows of one input batch in batches of bounded size."""

    def outer():
        step = make()

        def collected(rows):
            held: dict[str, list] = {}
            size = 0
            for out in step(rows):
                for name, values in out.items():
                    held.setdefault(name, []).extend(values)
                size += 200 + len(out["text"][0] or "") + len(out["words"][0] or b"")
                if size > 1 << 22:
                    yield held
                    held, size = {}, 0
            if held:
                yield held

        return collected

    return outer


# ---- one tile


def z_function(words: list[int], places: list[int]) -> list[int]:
    """How many words from each place on equal the first ones; ``places``, in
    ascending order, are those with the first word, all others have none."""
    n = len(words)
    out = [0] * n
    left = right = 0
    for i in places:
        if i == 0:
            continue
        length = 0
        if i < right:
            length = out[i - left]
            if i + length < right:
                out[i] = length
                continue
            length = right - i
        while i + length < n and words[length] == words[i + length]:
            length += 1
        out[i] = length
        left, right = i, i + length
    if n:
        out[0] = n
    return out


def z_of(words: np.ndarray) -> np.ndarray:
    if not len(words):
        return np.zeros(0, np.int64)
    return np.array(z_function(words.tolist(), np.flatnonzero(words == words[0]).tolist()), np.int64)


def fragments(octave: int, words: np.ndarray, boundary: int) -> list[tuple[int, int, int]]:
    """(period, start, end) of matching places around a boundary, as far as the
    tile looks, for those periods of the octave that no smaller one repeats to."""
    look = reach(octave)
    after = words[boundary : boundary + 2 * octave + look]
    forward = z_of(after)
    periods = octave + np.flatnonzero(forward[octave : 2 * octave])
    if not len(periods):
        return []
    whole = np.ones(2 * octave, bool)
    for root in (1 + np.flatnonzero(forward[1:octave] >= np.arange(1, min(octave, len(forward))))).tolist():
        if whole[root]:
            whole[2 * root : int(forward[root]) + root + 1 : root] = False
    periods = periods[whole[periods]]
    if not len(periods):
        return []
    start = max(0, boundary - look)
    before = words[start:boundary][::-1]
    # Reversed words up to the place before each period's return, behind the reversed words before the boundary.
    last = min(len(words), boundary + 2 * octave - 1)
    backward = z_of(np.concatenate([before, [-1], words[start:last][::-1]]))
    back = backward[len(before) + 1 + last - boundary - periods] if len(before) else np.zeros(len(periods), np.int64)
    out = []
    for period, ahead, behind in zip(periods.tolist(), forward[periods].tolist(), back.tolist(), strict=True):
        ahead, behind = min(ahead, look), min(behind, look)
        if look in (ahead, behind) or ahead + behind >= matches_needed(period):
            out.append((period, boundary - behind, boundary + ahead))
    return out


def solved(tiles: DataFrame) -> DataFrame:
    """Fragments of all tiles, those of one row of tiles stitched already."""

    def make():
        def step(rows):
            out = {"key": [], "period": [], "start": [], "end": []}
            for key, octave, first, words, boundaries in zip(*(rows[c] for c in TILE), strict=True):
                words = np.frombuffer(words, "<i4")
                open_: dict[int, list[int]] = {}
                for boundary in np.frombuffer(boundaries, "<i4").tolist():
                    for period, start, end in fragments(octave, words, boundary):
                        held = open_.get(period)
                        if held is not None and start <= held[1]:
                            held[1] = max(held[1], end)
                            continue
                        if held is not None:
                            emit(out, key, period, first, held)
                        open_[period] = [start, end]
                for period, held in open_.items():
                    emit(out, key, period, first, held)
            yield out

        def emit(out, key, period, first, held):
            out["key"].append(key)
            out["period"].append(period)
            out["start"].append(first + held[0])
            out["end"].append(first + held[1])

        return step

    return map_batches(tiles, make, "key bigint, period bigint, start bigint, end bigint")


def stitched(found: DataFrame) -> DataFrame:
    """Runs (key, start, length, period) from fragments of matching places."""
    along = Window.partitionBy("key", "period").orderBy("start", "end")
    reached = F.max("end").over(along.rowsBetween(Window.unboundedPreceding, -1))
    numbered = found.withColumn("opens", (reached.isNull() | (F.col("start") > reached)).cast("int")).withColumn(
        "run", F.sum("opens").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    length = F.col("end") - F.col("start") + F.col("period")
    return (
        numbered.groupBy("key", "period", "run")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .select("key", "start", length.alias("length"), "period")
        .filter((F.col("length") >= MIN_LENGTH) & (F.col("length") >= MIN_REPEATS * F.col("period")))
    )


# ---- results per document


def report(words: list[bytes], runs: list[tuple[int, int, int]]) -> dict:
    """The result columns of one document, given (start, length, period)."""
    runs = sorted(runs, key=lambda r: (r[0], r[2]))
    edges = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(edges[:-1]) == 0).tolist()
    start, length, period = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
    listing = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    return {
        "n_runs": len(runs),
        "start": start,
        "length": length,
        "period": period,
        "exponent_milli": None if period is None else 1000 * length // period,
        "runs_sha256": hashlib.sha256(listing.encode()).hexdigest(),
        "collapsed_sha256": hashlib.sha256(b" ".join([words[i] for i in kept])).hexdigest(),
    }


RESULT = (
    "doc_id bigint, n_words bigint, n_runs bigint, start bigint, length bigint, period bigint, "
    "exponent_milli bigint, runs_sha256 string, collapsed_sha256 string"
)


def periodic_runs(docs: DataFrame, change: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """Per document its runs in short: their number, the longest, and digests
    of all runs and of the words that are left when each run is cut to its
    first period. ``change`` may rewrite a document's words beforehand."""
    rows = via_table(prepared(docs, change), "period-tiles")
    tiles = rows.filter(F.col("octave").isNotNull()).select(*TILE)
    # Solving costs far more than moving, so the tasks follow the number of rows, not their bytes.
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, -(-tiles.count() // TASK_ROWS))
    spread = tiles.repartition(tasks, "key", "octave", "first")
    runs = stitched(solved(spread)).groupBy("key").agg(F.collect_list(F.struct("start", "length", "period")).alias("runs"))
    open_ = rows.filter(F.col("text").isNotNull()).select("key", "doc_id", "n_words", "text").join(runs, "key", "left")

    def make():
        def step(rows):
            for doc_id, n_words, text, found in zip(*(rows[c] for c in ("doc_id", "n_words", "text", "runs")), strict=True):
                triples = [(r["start"], r["length"], r["period"]) for r in found or ()]
                out = report(text.encode().split(b" "), triples)
                yield {"doc_id": [doc_id], "n_words": [n_words], **{k: [v] for k, v in out.items()}}

        return step

    reported = map_batches(open_, make, RESULT)
    none = F.lit(None).cast("bigint")
    finished = rows.filter(F.col("collapsed").isNotNull()).select(
        "doc_id",
        "n_words",
        F.lit(0).cast("bigint").alias("n_runs"),
        *[none.alias(c) for c in ("start", "length", "period", "exponent_milli")],
        F.lit(NO_RUNS).alias("runs_sha256"),
        F.col("collapsed").alias("collapsed_sha256"),
    )
    return reported.unionByName(finished)


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The registered query's rule: one document in ten becomes periodic from some word on."""
    if doc_id is None or not words:
        return words
    chosen, rest = zlib.crc32(str(doc_id).encode()) % 10, zlib.crc32(str(doc_id).encode()) // 10
    if chosen:
        return words
    n = len(words)
    at = rest % n
    period = 1 + (n - at) // (3 + rest % 8)
    return [words[i] if i < at else words[at + (i - at) % period] for i in range(n)]


def op11_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    return periodic_runs(documents(spark, sf), planted)
