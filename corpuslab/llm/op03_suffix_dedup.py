"""Removal of repeated byte strings by refinement of suffix buckets.

A string of ``LENGTH`` bytes is removed from every document but those with the
smallest doc_id it starts in. Suffixes are sorted as far as this needs:

1. Anchors. Of the ``GRAM``-byte strings inside each window of ``LENGTH`` bytes
   the one with the smallest hash is the window's anchor. It depends on the
   window alone, so equal windows have equal anchors, and about one position in
   sixteen is an anchor. Anchors that occur in one text only are dropped; which
   do, is seen where all entries of an anchor meet. Anchors of very many texts
   are counted in the tasks first and their entries are not gathered at all.
2. Initial buckets. Each remaining anchor sends the bytes that its windows cover
   to the bucket of its gram, which thus gets all suffixes that can be equal.
   Copies inside a group of documents stay behind, since all but the first are
   known to be repeats. The windows of an anchor found in very many texts are
   sent one by one to the bucket of their whole content, cut into parts by group:
   of each part only the first texts with a window go on to where all parts meet.
3. Refinement. Suffixes with equal grams are sorted by the pair (bucket of the
   suffix, bucket of the suffix that starts where that one's compared bytes
   end); the new buckets are used in the same way, which doubles the length,
   until ``LENGTH`` bytes are told apart. The smallest doc_id of a bucket tells
   which of its windows go.

Whole copies are found first by digest and only their first text is compared.
Rows with null or short text lose nothing; very long texts are worked on in runs
of ``RUN`` bytes; rows with null doc_id come after all others and are no source
for each other; repeated rows of one doc_id get the
same result; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpuslab.operators.skew import lookup_join
from corpuslab.session import via_table

from .common import documents, map_batches
from .wordhash import BASE, MIX, Powers

LENGTH = 50
GRAM = 20
WINDOWS = LENGTH - GRAM + 1
CONTEXT = 2 * LENGTH - GRAM
RUN = 1 << 20
PLACE = np.uint64((1 << 24) - 1)
ID_BITS = 47
IDS = np.uint64((1 << ID_BITS) - 1)
HOT_TEXTS = 50_000
HOT_LIST = 200_000
LOCAL = 8
BUCKET_BYTES = 8 << 20
GROUP_BYTES = 1 << 20
FLUSH = 2_000_000
RECORDS = 20_000
BROADCAST_BYTES = 32 << 20
ROW_BYTES = 64
LAST = 2**63 - 1


# ---- packed arrays


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays of known types as one value: their lengths, then their bytes."""
    sizes = np.array([len(a) for a in arrays], "<u4")
    return b"".join([sizes.tobytes(), *(np.ascontiguousarray(a).tobytes() for a in arrays)])


def unpacked(value: bytes, *types: str) -> list[np.ndarray]:
    sizes, at, out = np.frombuffer(value, "<u4", len(types)), 4 * len(types), []
    for size, kind in zip(sizes.tolist(), types, strict=True):
        out.append(np.frombuffer(value, kind, size, at))
        at += out[-1].nbytes
    return out


def short(ids: np.ndarray) -> np.ndarray:
    """48-bit numbers as rows of 6 bytes."""
    return np.ascontiguousarray(ids.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).view("V6").ravel()


def long(ids: np.ndarray) -> np.ndarray:
    out = np.zeros((len(ids), 8), np.uint8)
    out[:, :6] = ids.view(np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def split_rows(keys: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Each value of ascending ``keys`` with its rows."""
    cuts = np.flatnonzero(np.diff(keys)) + 1
    for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)], strict=True):
        if end > begin:
            yield int(keys[begin]), slice(begin, end)


# ---- anchors


def gram_hashes(raw: np.ndarray, held: Powers) -> np.ndarray:
    up, down = held.get(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(raw * up[: len(raw)], out=sums[1:])
    out = (sums[GRAM:] - sums[:-GRAM]) * down[: len(raw) - GRAM + 1]
    out ^= out >> np.uint64(32)
    out *= MIX
    return out ^ (out >> np.uint64(29))


def run_anchors(raw: np.ndarray, doc: np.ndarray, held: Powers) -> tuple[np.ndarray, ...]:
    """Place, first and last window, and id of each anchor of bytes that belong
    to the documents ``doc``."""
    count = len(raw) - LENGTH + 1
    if count <= 0:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    hashes = gram_hashes(raw, held)
    least = (hashes & ~PLACE) | np.arange(len(hashes), dtype=np.uint64)
    width = 1
    while 2 * width <= WINDOWS:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = WINDOWS - width
    least = np.minimum(least[: len(least) - rest], least[rest:])[:count]
    whole = np.flatnonzero(doc[:count] == doc[LENGTH - 1 :])
    if not len(whole):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    place = (least[whole] & PLACE).astype(np.int64)
    new = np.append(True, (np.diff(place) != 0) | (np.diff(whole) != 1))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(whole)) - 1
    # Anchors have small hashes, so their ids are mixed once more.
    ids = (hashes[place[first]] * np.uint64(BASE)) >> np.uint64(64 - ID_BITS)
    return place[first], whole[first], whole[last], ids


def anchors(texts: list[bytes], held: Powers) -> tuple[np.ndarray, ...]:
    """All bytes, the document of each anchor, and what ``run_anchors`` gives,
    over texts of any length; runs overlap by one window less a byte."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    raw = np.frombuffer(b"".join(texts), np.uint8)
    doc = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    found = []
    for at in range(0, max(1, len(raw)), RUN):
        piece = slice(at, at + RUN + LENGTH - 1)
        place, first, last, ids = run_anchors(raw[piece], doc[piece], held)
        found.append((place + at, first + at, last + at, ids))
    place, first, last, ids = (np.concatenate(c) for c in zip(*found, strict=True))
    return raw, np.cumsum(sizes) - sizes, doc[place] if len(place) else np.zeros(0, np.int32), place, first, last, ids


# ---- refinement


def hashed(rows: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row of bytes."""
    wide = np.zeros((len(rows), -(-rows.shape[1] // 8) * 8), np.uint8)
    wide[:, : rows.shape[1]] = rows
    out = np.zeros(len(rows), np.uint64)
    for column in wide.view("<u8").T:
        out = (out ^ column) * np.uint64(BASE)
        out ^= out >> np.uint64(29)
    return out


def distinct(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place of each distinct row of bytes, and every row's number."""
    rows = np.ascontiguousarray(rows)
    _, some, same = np.unique(hashed(rows), return_index=True, return_inverse=True)
    if not (rows == rows[some[same]]).all():  # two rows with one hash
        _, some, same = np.unique(rows.view(f"V{rows.shape[1]}").ravel(), return_index=True, return_inverse=True)
    return some, same


def ranked(*columns: np.ndarray) -> np.ndarray:
    """Bucket numbers of rows of two columns, in their sorted order."""
    if len(columns) == 1:
        return np.unique(columns[0], return_inverse=True)[1].reshape(columns[0].shape)
    left, right = (ranked(c) if c.dtype == np.uint64 else c for c in columns)
    pairs = left.astype(np.uint64) * np.uint64(int(right.max(initial=0)) + 1) + right.astype(np.uint64)
    return ranked(pairs)


def refine(rows: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Buckets of the suffixes of each row of bytes, equal if and only if their
    first ``length`` bytes are. The first buckets are the 8-byte grams."""
    starts = rows.shape[1] - 8 + 1
    grams = np.zeros((len(rows), starts), np.uint64)
    for i in range(8):
        grams = grams << np.uint64(8) | rows[:, i : i + starts]
    known = {8: ranked(grams)}
    told = 8
    while told < length:
        # The longest known buckets that do not pass the length, at the later offset.
        step = max((k for k in known if told + k <= length), default=0)
        offset, step = (told, step) if step else (length - 8, 8)
        buckets, later = known[told], known[step]
        shared = min(buckets.shape[1], later.shape[1] - offset)
        told = offset + step
        known[told] = ranked(buckets[:, :shared], later[:, offset : offset + shared])
    return known[told]


# ---- step 1: anchors of several texts


def _key(sha: bytes) -> int:
    return int.from_bytes(sha[:8], "little")


def _group(digest: str, groups: int) -> Column:
    """Group of documents, from other bits of the digest than the key."""
    return F.pmod(F.conv(F.hex(F.substring(digest, 9, 7)), 16, 10).cast("bigint"), F.lit(groups)).cast("int")


def once_in_a_text(texts: list[bytes], held: Powers) -> np.ndarray:
    """Text and anchor id in one number, for each anchor of each text once."""
    *_, doc, _, _, _, ids = anchors(texts, held)
    return np.unique(doc.astype(np.uint64) << np.uint64(ID_BITS) | ids)


def frequent_anchors(texts: DataFrame) -> np.ndarray:
    """Ascending ids of anchors that occur in more than ``HOT_TEXTS`` texts, at
    most ``HOT_LIST``, the most frequent first.

    A task counts ``FLUSH`` entries at a time and passes on ids that it saw
    ``LOCAL`` times, so an anchor may be missed. The list only says which entries
    need not be gathered: results are the same whatever is on it.
    """

    def make():
        held = Powers()
        parts: list[np.ndarray] = []

        def flush():
            if parts:
                ids, n = np.unique(np.concatenate(parts), return_counts=True)
                parts.clear()
                often = n >= LOCAL
                yield {"id": ids[often].astype(np.int64), "n": n[often]}

        def step(rows):
            parts.append(once_in_a_text([t.encode() for t in rows["text"]], held) & IDS)
            if sum(map(len, parts)) > FLUSH:
                yield from flush()

        step.finish = flush
        return step

    counted = map_batches(texts.select("text"), make, "id bigint, n bigint")
    totals = counted.groupBy("id").agg(F.sum("n").alias("n")).filter(F.col("n") > HOT_TEXTS)
    listed = totals.orderBy(F.desc("n"), "id").limit(HOT_LIST).select("id").toArrow()
    return np.sort(listed["id"].to_numpy().astype(np.uint64))


def anchor_rows(texts: DataFrame, buckets: int, hot: np.ndarray) -> DataFrame:
    """bucket, and packed keys, groups, counts and anchor ids of some texts,
    without the ids in ``hot``."""

    def make():
        held = Powers()
        docs: dict[str, list] = {"key": [], "grp": []}
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def flush():
            nonlocal size
            if size:
                doc, ids = (np.concatenate(c) for c in zip(*parts, strict=True))
                keys, groups = np.array(docs["key"], np.uint64), np.array(docs["grp"], np.int32)
                bucket = (ids % np.uint64(buckets)).astype(np.int64)
                turn = np.empty(len(keys), np.int64)
                turn[np.argsort(groups, kind="stable")] = np.arange(len(keys))
                order = np.argsort(bucket * len(keys) + turn[doc])
                doc, ids, bucket = doc[order], ids[order], bucket[order]
                for number, rows in split_rows(bucket):
                    own, counts = _runs(doc[rows])
                    value = packed(keys[own], groups[own], counts.astype("<u4"), short(ids[rows]))
                    yield {"bucket": [number], "value": [value]}
            for kept in (parts, docs["key"], docs["grp"]):
                kept.clear()
            size = 0

        def step(rows):
            nonlocal size
            once = once_in_a_text([t.encode() for t in rows["text"]], held)
            once = once[~np.isin(once & IDS, hot)]
            parts.append(((once >> np.uint64(ID_BITS)).astype(np.int64) + len(docs["key"]), once & IDS))
            docs["key"] += [_key(sha) for sha in rows["sha"]]
            docs["grp"] += rows["grp"]
            size += len(once)
            if size > FLUSH:
                yield from flush()

        step.finish = flush
        return step

    return map_batches(texts.select("sha", "grp", "text"), make, "bucket int, value binary")


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of consecutive equal entries and their counts."""
    first = np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.zeros(0, np.int64)
    return values[first], np.diff(np.append(first, len(values)))


def shared_anchors(rows: DataFrame) -> DataFrame:
    """grp, and packed keys, counts and ids (the highest bit marks very frequent
    ones) of the anchors that occur in several texts. A bucket holds about
    ``BUCKET_BYTES``, since an anchor counts once in a text, ids are spread by
    their hash, and the most frequent anchors are not among ``rows``."""

    def shared(frame: pd.DataFrame) -> pd.DataFrame:
        parts = [unpacked(v, "<u8", "<i4", "<u4", "V6") for v in frame["value"]]
        ids = long(np.concatenate([p[3] for p in parts]))
        keys = np.concatenate([np.repeat(p[0], p[2]) for p in parts])
        groups = np.concatenate([np.repeat(p[1], p[2]) for p in parts])
        _, inverse, counts = np.unique(ids, return_inverse=True, return_counts=True)
        times = counts[inverse]
        kept = np.flatnonzero(times > 1)
        ids = ids[kept] | ((times[kept] > HOT_TEXTS).astype(np.uint64) << np.uint64(ID_BITS))
        keys, groups = keys[kept], groups[kept]
        order = np.lexsort((keys, groups))
        ids, keys, groups = ids[order], keys[order], groups[order]
        out = []
        for group, own in split_rows(groups):
            key, count = _runs(keys[own])
            out.append((group, packed(key, count.astype("<u4"), short(ids[own]))))
        return pd.DataFrame(out, columns=["grp", "value"])

    return rows.groupBy("bucket").applyInPandas(shared, "grp int, value binary")


# ---- step 2: bytes around shared anchors, by bucket

RECORD = ["<u8", "<i8", "<i8", "u1", "u1", f"V{CONTEXT}"]


def contexts(texts: DataFrame, shared: DataFrame, buckets: int, parts: int, listed: np.ndarray) -> DataFrame:
    """bucket, part, grp, done, and packed records: key, order and place of the
    text, first and last window, and the bytes they cover. Rows with ``done``
    hold windows (key, start, end) already known to be repeats. The anchors are
    those of ``shared`` and the ``listed`` ones; windows of the very frequent
    ones are dealt over ``parts`` parts by group, other rows are in part -1."""

    def around(key, texts: pd.DataFrame, shared: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"bucket": [], "part": [], "grp": [], "done": [], "value": []})
        if not len(texts) or not (len(shared) or len(listed)):
            return empty
        held = Powers()
        raw, begins, doc, place, first, last, ids = anchors([t.encode() for t in texts["text"]], held)
        keys = np.array([_key(sha) for sha in texts["sha"]], np.uint64)
        orders = texts["first"].to_numpy(np.int64)
        number = {k: i for i, k in enumerate(keys.tolist())}
        known = [unpacked(v, "<u8", "<u4", "V6") for v in shared["value"]]
        wanted_ids = np.concatenate([np.zeros(0, np.uint64), *(long(p[2]) for p in known)])
        of_doc = np.concatenate(
            [
                np.zeros(0, np.int64),
                *(np.repeat(np.array([number.get(k, -1) for k in p[0].tolist()], np.int64), p[1]) for p in known),
            ]
        )
        plain = wanted_ids & IDS
        if len(keys) >> (64 - ID_BITS):
            raise ValueError("too many texts in a group")
        wanted = of_doc.astype(np.uint64) << np.uint64(ID_BITS) | plain
        hot = np.union1d(plain[wanted_ids >> np.uint64(ID_BITS) > 0], listed)
        in_several = np.isin(doc.astype(np.uint64) << np.uint64(ID_BITS) | ids, wanted[of_doc >= 0])
        kept = np.flatnonzero(in_several | np.isin(ids, listed))
        if not len(kept):
            return empty
        doc, place, first, last, ids = (a[kept] for a in (doc, place, first, last, ids))
        many = np.isin(ids, hot)
        if many.any():
            # One record per window, sent by the window's own content.
            counts = np.where(many, last - first + 1, 1)
            at = np.repeat(np.arange(len(place)), counts)
            step = np.arange(len(at)) - np.repeat(np.cumsum(counts) - counts, counts)
            doc, place, ids, many = doc[at], place[at], ids[at], many[at]
            first = first[at] + np.where(many, step, 0)
            last = np.where(many, first, last[at])
        out = []
        for begin in range(0, len(place), RECORDS):
            part = slice(begin, begin + RECORDS)
            own = (a[part] for a in (doc, place, first, last, ids, many))
            out += _records(raw, begins, keys, orders, buckets, *own)
        frame = pd.DataFrame(out, columns=["bucket", "part", "done", "value"])
        frame["part"] = np.where(frame["part"], int(key[0]) % parts, -1)
        frame.insert(2, "grp", int(key[0]))
        return frame

    return (
        texts.groupBy("grp")
        .cogroup(shared.groupBy("grp"))
        .applyInPandas(around, "bucket int, part int, grp int, done boolean, value binary")
    )


def _records(raw, begins, keys, orders, buckets, doc, place, first, last, ids, many) -> list[tuple]:
    left = place - (WINDOWS - 1)
    low, high = (first - left).astype(np.uint8), (last - left).astype(np.uint8)
    offsets = np.arange(CONTEXT)
    at = left[:, None] + offsets
    covered = (at >= first[:, None]) & (at < last[:, None] + LENGTH)
    rows = np.where(covered, raw[np.clip(at, 0, len(raw) - 1)], 0).astype(np.uint8)
    some, same = distinct(np.concatenate([low[:, None], high[:, None], rows], axis=1))
    smallest = np.full(len(some), LAST, np.int64)
    np.minimum.at(smallest, same, orders[doc])
    repeat = orders[doc] > smallest[same]
    out = []
    if repeat.any():
        own = doc[repeat]
        value = packed(keys[own], first[repeat] - begins[own], last[repeat] + LENGTH - begins[own])
        out.append((int(keys[own[0]] % np.uint64(buckets)), False, True, value))
    sent = np.flatnonzero(~repeat)
    target = ids.copy()
    if many.any():
        target[many] = [
            int.from_bytes(hashlib.blake2b(rows[i].tobytes(), digest_size=6).digest(), "little") for i in np.flatnonzero(many)
        ]
    bucket = (target[sent] % np.uint64(buckets)).astype(np.int64) * 2 + many[sent]
    order = np.argsort(bucket, kind="stable")
    for number, some in split_rows(bucket[order]):
        r = sent[order[some]]
        value = packed(
            keys[doc[r]], orders[doc[r]], left[r] - begins[doc[r]], low[r], high[r], rows[r].view(f"V{CONTEXT}").ravel()
        )
        out.append((number // 2, bool(number % 2), False, value))
    return out


# ---- step 3: buckets refined


def repeated_windows(rows: DataFrame) -> DataFrame:
    """grp, and packed key, start and end of byte ranges to remove.

    Each part of a bucket is refined by itself. Of the windows of very frequent
    anchors each part passes on those of its smallest order (one per content, but
    for texts that share a doc_id), and a second refinement compares these.
    """

    def refined(frame: pd.DataFrame, onward: bool) -> list[tuple]:
        done = frame["done"].to_numpy(bool)
        out = [(None, g, v) for g, v in zip(frame["grp"][done], frame["value"][done], strict=True)]
        sent = frame[~done]
        if not len(sent):
            return out
        packs = [unpacked(v, *RECORD) for v in sent["value"]]
        group = np.repeat(sent["grp"].to_numpy(), [len(p[0]) for p in packs])
        key, order, left, low, high, row = (np.concatenate(c) for c in zip(*packs, strict=True))
        begin, end = removed(order, low, high, row)
        by_group = np.argsort(group, kind="stable")
        gone = end[by_group] > begin[by_group]
        hit = by_group[gone]
        for number, some in split_rows(group[hit]):
            r = hit[some]
            out.append((None, number, packed(key[r], left[r] + begin[r], left[r] + end[r])))
        if onward:
            first = by_group[~gone]
            bucket = int(frame["bucket"].iloc[0])
            for number, some in split_rows(group[first]):
                r = first[some]
                out.append((bucket, number, packed(key[r], order[r], left[r], low[r], high[r], row[r])))
        return out

    def in_part(key: tuple[Any, ...], frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(refined(frame, key[1] >= 0), columns=["bucket", "grp", "value"])

    def over_parts(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(refined(frame.assign(done=False), False), columns=["bucket", "grp", "value"])

    schema = "bucket int, grp int, value binary"
    first = via_table(rows.groupBy("bucket", "part").applyInPandas(in_part, schema), "ranges-in-parts")
    second = first.filter("bucket IS NOT NULL").groupBy("bucket").applyInPandas(over_parts, schema)
    return first.filter("bucket IS NULL").unionByName(second).select("grp", "value")


def removed(order: np.ndarray, low: np.ndarray, high: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per record the range of its bytes that windows of smaller order hold. Any
    two windows of a record overlap, so the range has no gap."""
    some, same = distinct(np.concatenate([low[:, None], high[:, None], row.view(np.uint8).reshape(-1, CONTEXT)], axis=1))
    smallest = np.full(len(some), LAST, np.int64)
    np.minimum.at(smallest, same, order)
    rows, lows, highs = row[some].view(np.uint8).reshape(-1, CONTEXT), low[some].astype(int), high[some].astype(int)
    _, gram, counts = np.unique(
        hashed(rows[:, WINDOWS - 1 : WINDOWS - 1 + GRAM]), return_inverse=True, return_counts=True
    )
    least = np.broadcast_to(smallest[:, None], (len(some), WINDOWS)).copy()
    several = np.flatnonzero(counts[gram] > 1)
    if len(several):
        buckets = refine(rows[several])[:, :WINDOWS]
        offset = np.arange(WINDOWS)
        valid = (offset >= lows[several, None]) & (offset <= highs[several, None])
        best = np.full(int(buckets.max()) + 1, LAST, np.int64)
        np.minimum.at(best, buckets[valid], np.broadcast_to(smallest[several, None], valid.shape)[valid])
        least[several] = np.where(valid, best[buckets], LAST)
    offset = np.arange(WINDOWS)
    gone = (least[same] < order[:, None]) & (offset >= low[:, None]) & (offset <= high[:, None])
    any_gone = gone.any(axis=1)
    begin = np.where(any_gone, gone.argmax(axis=1), 0)
    end = np.where(any_gone, WINDOWS - 1 - gone[:, ::-1].argmax(axis=1) + LENGTH, 0)
    return begin, end


# ---- the job


def merged(ranges: DataFrame) -> DataFrame:
    """Per text: grp, key, n_removed, n_spans and the packed maximal ranges."""

    def union(frame: pd.DataFrame) -> pd.DataFrame:
        parts = [unpacked(v, "<u8", "<i8", "<i8") for v in frame["value"]]
        key, begin, end = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.lexsort((begin, key))
        key, begin, end = key[order], begin[order], end[order]
        out = []
        for _, own in split_rows(np.unique(key, return_inverse=True)[1]):
            b, reach = begin[own], np.maximum.accumulate(end[own])
            new = np.flatnonzero(np.append(True, b[1:] > reach[:-1]))
            starts, ends = b[new], reach[np.append(new[1:], len(b)) - 1]
            size = int((ends - starts).sum())
            out.append((int(frame["grp"].iloc[0]), key[own][:1].view(np.int64)[0], size, len(new), packed(starts, ends)))
        return pd.DataFrame(out, columns=["grp", "key", "n_removed", "n_spans", "ranges"])

    return ranges.groupBy("grp").applyInPandas(
        union, "grp int, key bigint, n_removed bigint, n_spans bigint, ranges binary"
    )


def checked(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """A written table, marked for broadcast if its rows take at most ``most``
    bytes; beyond that the join shuffles."""
    binary = [F.octet_length(c) for c, kind in df.dtypes if kind == "binary"]
    size = df.agg(F.sum(sum(binary, F.lit(ROW_BYTES)))).first()[0] or 0
    return F.broadcast(df) if size <= most else df


def kept_digests(texts: DataFrame) -> DataFrame:
    """sha, and the digest of each text without its ranges."""

    def make():
        def step(rows):
            digests = []
            for text, ranges in zip(rows["text"], rows["ranges"], strict=True):
                raw, (starts, ends) = text.encode(), unpacked(ranges, "<i8", "<i8")
                own, at = hashlib.sha256(), 0
                for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
                    own.update(raw[at:s])
                    at = e
                own.update(raw[at:])
                digests.append(own.hexdigest())
            yield {"sha": rows["sha"], "kept_sha256": digests}

        return step

    return map_batches(texts.select("sha", "text", "ranges"), make, "sha binary, kept_sha256 string")


def key_of(digest: str) -> Column:
    """The digest's first 8 bytes as a little-endian number, like ``_key``."""
    parts = [F.conv(F.hex(F.substring(digest, i + 1, 1)), 16, 10).cast("bigint") for i in range(8)]
    out = parts[0]
    for i, part in enumerate(parts[1:], 1):
        out = out.bitwiseOR(F.shiftleft(part, 8 * i))
    return out


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans and kept_sha256."""
    text = F.coalesce(F.col("text"), F.lit(""))
    order = F.coalesce(F.col("doc_id"), F.lit(LAST))
    digest = F.unhex(F.sha2(text, 256))
    all_rows = docs.select("doc_id", order.alias("ord"), digest.alias("sha"), text.alias("text"))
    measured = all_rows.select("doc_id", "ord", "sha", F.octet_length("text").cast("bigint").alias("n_bytes"))
    rows = via_table(measured, "texts")
    # Copies are combined before they move.
    counted = rows.groupBy("sha").agg(
        F.min("ord").alias("first"), F.count(F.lit(1)).alias("n"), F.first("n_bytes").alias("n_bytes")
    )
    first = via_table(counted, "first-texts")
    total = first.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    buckets, groups = max(8, total // BUCKET_BYTES), max(8, total // GROUP_BYTES)

    # Of each text one row goes on: by broadcast of the other copies while these are few.
    several = via_table(first.filter("n > 1").select("sha", "first", "n"), "copied-texts")
    of_several = via_table(lookup_join(rows, several, "sha", "n").drop("n"), "rows-of-copied-texts")
    copies = checked(via_table(of_several.filter("ord > first").select("sha", "ord").distinct(), "copies"))
    once = all_rows.join(copies, ["sha", "ord"], "left_anti")
    if not of_several.filter("ord = first").groupBy("sha").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
        once = once.dropDuplicates(["sha"])
    texts = once.filter(F.octet_length("text") >= LENGTH).select(
        "sha", F.col("ord").alias("first"), "text", _group("sha", groups).alias("grp")
    )

    # An anchor counts once in a text, so few texts have no frequent one.
    many = first.filter(F.col("n_bytes") >= LENGTH).count() > HOT_TEXTS
    hot = frequent_anchors(texts) if many else np.zeros(0, np.uint64)
    shared = via_table(shared_anchors(anchor_rows(texts, buckets, hot)), "shared-anchors")
    parts = math.isqrt(groups) + 1
    ranges = repeated_windows(contexts(texts, shared, buckets, parts, hot))
    spans = via_table(merged(ranges), "spans")

    keyed = first.select("sha", key_of("sha").alias("key"), _group("sha", groups).alias("grp"))
    found = via_table(keyed.join(spans, ["grp", "key"]).select("sha", "n_removed", "n_spans", "ranges"), "text-spans")
    cut = kept_digests(texts.join(checked(found.select("sha", "ranges")), "sha"))
    with_spans = first.select("sha", "first", "n").join(found.drop("ranges"), "sha", "left")
    by_text = via_table(with_spans.join(cut, "sha", "left"), "results-by-text")
    copied = (F.col("ord") > F.col("first")) & (F.col("n_bytes") >= LENGTH)
    return lookup_join(rows, by_text, "sha", "n").select(
        "doc_id",
        "n_bytes",
        F.when(copied, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(copied, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("bigint").alias("n_spans"),
        F.when(copied, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", F.lower(F.hex("sha")))).alias("kept_sha256"),
    )


def op3_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return remove_repeats(documents(spark, sf))
