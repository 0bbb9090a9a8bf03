"""Byte-level BPE by published ranks: encoding and decoding.

A piece (one match of the split pattern) starts as single bytes. The leaves of
a segment tree over its byte positions hold the rank of the pair that starts
there, and every inner node the smallest (rank, position) below it, so the root
names the leftmost pair of the lowest rank. A merge changes three leaves: the
pair at the merged place, the one before it, and the right part, which is gone;
their paths to the root are updated. Pieces of up to 64 bytes are worked on as
batches of trees of one size, longer ones alone, both in O(log n) per merge.

Rows with null or empty text have no ids; repeated rows are each encoded; an
empty table gives no rows; columns besides doc_id and text are not read.
"""

from __future__ import annotations

import base64
import hashlib
import unicodedata
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from .common import documents, map_batches, slices, texts
from .units import UnitCoder, worker_table

SLICE_CHARS = 1_000_000
BATCH_BYTES = 64
BATCH_PIECES = 20_000
NONE = np.int64(2**62)
PROBE = r"'s| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"
#: The white space of the split pattern, Unicode's White_Space.
SPACE = r"\t-\r \x85\xa0  -     　"


@dataclass(frozen=True)
class Ranks:
    """A rank file as arrays: the bytes of each id, the id of each single byte,
    and the merged id of each pair (left << 32 | right), sorted by pair."""

    tokens: tuple[bytes, ...]
    of_byte: np.ndarray
    pairs: np.ndarray
    merged: np.ndarray


def read_ranks(path: str) -> Ranks:
    with open(path, "rb") as lines:
        known = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    tokens = [b""] * (max(known.values()) + 1)
    found = {}
    for token, rank in known.items():
        tokens[rank] = token
        for cut in range(1, len(token)):
            left, right = known.get(token[:cut]), known.get(token[cut:])
            if left is not None and right is not None:
                found[left << 32 | right] = rank
    pairs = np.array(sorted(found), np.int64)
    return Ranks(
        tuple(tokens),
        np.array([known[bytes([b])] for b in range(256)], np.int64),
        pairs,
        np.array([found[p] for p in pairs.tolist()], np.int64),
    )


def pair_ranks(ranks: Ranks, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Merged id of each pair, or -1."""
    wanted = left << 32 | right
    at = np.minimum(np.searchsorted(ranks.pairs, wanted), len(ranks.pairs) - 1)
    return np.where(ranks.pairs[at] == wanted, ranks.merged[at], -1)


def merge_batch(ranks: Ranks, pieces: list[bytes], width: int) -> list[np.ndarray]:
    """Ids of pieces of 2 to ``width`` bytes, ``width`` a power of two."""
    count = len(pieces)
    sizes = np.fromiter(map(len, pieces), np.int64, count)
    raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(count, width)
    inside = np.arange(width) < sizes[:, None]
    token = np.where(inside, ranks.of_byte[raw], -1)
    after = np.broadcast_to(np.arange(1, width + 1), (count, width)).copy()
    before = np.broadcast_to(np.arange(-1, width - 1), (count, width)).copy()
    tree = np.full((count, 2 * width), NONE)
    rows, places = np.nonzero(inside[:, 1:])
    rank = pair_ranks(ranks, token[rows, places], token[rows, places + 1])
    tree[rows, width + places] = np.where(rank >= 0, rank << 32 | places, NONE)
    level = width
    while level > 1:
        tree[:, level // 2 : level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
        level //= 2

    def put(rows, places, values):
        node = width + places
        tree[rows, node] = values
        while node[0] > 1:
            node >>= 1
            tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

    def pair_at(rows, places, others):
        ok = others < sizes[rows]
        rank = pair_ranks(ranks, token[rows, places], token[rows, np.where(ok, others, 0)])
        return np.where(ok & (rank >= 0), rank << 32 | places, NONE)

    live = np.flatnonzero(tree[:, 1] < NONE)
    while len(live):
        best = tree[live, 1]
        place = best & 0xFFFFFFFF
        gone = after[live, place]
        token[live, place] = best >> 32
        token[live, gone] = -1
        following = after[live, gone]
        after[live, place] = following
        has = following < sizes[live]
        before[live[has], following[has]] = place[has]
        put(live, gone, np.full(len(live), NONE))
        put(live, place, pair_at(live, place, following))
        earlier = before[live, place]
        has = earlier >= 0
        if has.any():
            put(live[has], earlier[has], pair_at(live[has], earlier[has], place[has]))
        live = live[tree[live, 1] < NONE]
    return [row[row >= 0] for row in token]


def merge_long(ranks: Ranks, piece: bytes) -> list[int]:
    """Ids of one piece of any length."""
    size = len(piece)
    width = 1 << (size - 1).bit_length()
    codes = ranks.of_byte[np.frombuffer(piece, np.uint8)]
    first = pair_ranks(ranks, codes[:-1], codes[1:])
    start = np.full(2 * width, NONE)
    start[width : width + size - 1] = np.where(first >= 0, first << 32 | np.arange(size - 1), NONE)
    level = width
    while level > 1:
        start[level // 2 : level] = np.minimum(start[level : 2 * level : 2], start[level + 1 : 2 * level : 2])
        level //= 2
    tree, token, none = start.tolist(), codes.tolist(), int(NONE)
    after, before = list(range(1, size + 1)), list(range(-1, size - 1))
    merged: dict[int, int] = {}

    def pair_at(place, other):
        if other >= size:
            return none
        key = token[place] << 32 | token[other]
        rank = merged.get(key)
        if rank is None:
            at = int(np.searchsorted(ranks.pairs, key))
            known = at < len(ranks.pairs) and ranks.pairs[at] == key
            rank = merged[key] = int(ranks.merged[at]) if known else -1
        return rank << 32 | place if rank >= 0 else none

    def put(place, value):
        node = width + place
        tree[node] = value
        while node > 1:
            node >>= 1
            left, right = tree[2 * node], tree[2 * node + 1]
            tree[node] = left if left < right else right

    while tree[1] < none:
        place = tree[1] & 0xFFFFFFFF
        gone = after[place]
        token[place], token[gone] = tree[1] >> 32, -1
        after[place] = after[gone]
        if after[gone] < size:
            before[after[gone]] = place
        put(gone, none)
        put(place, pair_at(place, after[place]))
        if before[place] >= 0:
            put(before[place], pair_at(before[place], place))
    return [t for t in token if t >= 0]


def encode_pieces(ranks: Ranks, whole: dict[bytes, int], pieces: list[bytes]) -> list[bytes]:
    """Ids of each piece as little-endian unsigned 32-bit integers. A piece that
    is itself a token is that token."""
    out: list[bytes] = [b""] * len(pieces)
    by_width: dict[int, list[int]] = {}
    for i, piece in enumerate(pieces):
        known = whole.get(piece)
        if known is not None:
            out[i] = known.to_bytes(4, "little")
        elif len(piece) > BATCH_BYTES:
            out[i] = np.array(merge_long(ranks, piece), "<u4").tobytes()
        else:
            by_width.setdefault(1 << (len(piece) - 1).bit_length(), []).append(i)
    for width, members in by_width.items():
        for at in range(0, len(members), BATCH_PIECES):
            some = members[at : at + BATCH_PIECES]
            for i, ids in zip(some, merge_batch(ranks, [pieces[i] for i in some], width), strict=True):
                out[i] = ids.astype("<u4").tobytes()
    return out


def newer_characters() -> str:
    """Letters and digits of the regex package that the installed tiktoken, with
    an older Unicode, does not know as such, as ranges of a character set. After
    a letter or digit a contraction is a match of its own, after others it is not."""
    import regex

    try:
        import tiktoken
    except ImportError:
        return ""
    ranks = {bytes([b]): b for b in range(256)} | {b"'s": 256}
    probe = tiktoken.Encoding("probe", pat_str=PROBE, mergeable_ranks=ranks, special_tokens={})
    every = "".join(map(chr, [*range(128, 0xD800), *range(0xE000, 0x110000)]))
    unsure = [c for c in regex.findall(r"[\p{L}\p{N}]", every) if unicodedata.category(c) == "Cn"]
    codes = [ord(c) for c in unsure if probe.encode_ordinary(c + "'s")[-1] != 256]
    starts = [c for c, before in zip(codes, [-1, *codes], strict=False) if c != before + 1]
    ends = [c for c, after in zip(codes, [*codes[1:], -1], strict=True) if after != c + 1]
    return "".join(f"\\U{s:08X}-\\U{e:08X}" for s, e in zip(starts, ends, strict=True))


def split_pattern(pattern: str) -> str:
    """``pattern`` for the regex package, with white space, letters and digits as
    in tiktoken."""
    spaced = pattern.replace(r"[^\s", "[^" + SPACE).replace(r"\S", f"[^{SPACE}]").replace(r"\s", f"[{SPACE}]")
    newer = newer_characters()
    if not newer:
        return spaced
    return "(?V1)" + spaced.replace(r"\p{L}", rf"[\p{{L}}--[{newer}]]").replace(r"\p{N}", rf"[\p{{N}}--[{newer}]]")


def unit_encoder(ranks: Ranks, pattern: str):
    """Packed ids of strings, each split by ``pattern`` (of ``split_pattern``)."""
    import regex

    split = regex.compile(pattern)
    whole = {token: rank for rank, token in enumerate(ranks.tokens) if token}

    def encode(strings: list[str]) -> list[bytes]:
        cut = [[p.encode() for p in split.findall(s)] for s in strings]
        pieces = list(dict.fromkeys(p for own in cut for p in own))
        ids = dict(zip(pieces, encode_pieces(ranks, whole, pieces), strict=True))
        return [b"".join(map(ids.__getitem__, own)) for own in cut]

    return encode


def encode_documents(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """doc_id and ids (little-endian unsigned 32-bit integers) of each text."""
    return _coded(docs, vocabulary, pattern, "ids binary", lambda ids, tokens: {"ids": ids})


def _coded(docs: DataFrame, vocabulary: str, pattern: str, columns: str, of) -> DataFrame:
    ranks, pattern = read_ranks(vocabulary), split_pattern(pattern)

    def make():
        code = UnitCoder(unit_encoder(ranks, pattern), 4, worker_table(f"trees {vocabulary} {pattern}"))

        def step(rows):
            for some in slices(rows["text"], SLICE_CHARS):
                yield {"doc_id": rows["doc_id"][some], **of(code(rows["text"][some]), ranks.tokens)}

        return step

    return map_batches(texts(docs), make, f"doc_id bigint, {columns}")


def decode(ids: bytes, tokens: tuple[bytes, ...]) -> bytes:
    return b"".join(map(tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def digests(ids: list[bytes], tokens: tuple[bytes, ...]) -> dict:
    return {
        "n_tokens": [len(i) // 4 for i in ids],
        "ids_sha256": [hashlib.sha256(i).hexdigest() for i in ids],
        "decoded_sha256": [hashlib.sha256(decode(i, tokens)).hexdigest() for i in ids],
    }


def encoded_digests(docs: DataFrame, vocabulary: str, pattern: str, keep_ids: bool = False) -> DataFrame:
    """Per document: the number of ids, and digests of the ids and of the bytes
    they decode to; with ``keep_ids`` the ids as well. Ids are decoded where
    they were made, so they need not move."""
    columns = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    if keep_ids:
        return _coded(
            docs, vocabulary, pattern, f"{columns}, ids binary", lambda ids, tokens: {**digests(ids, tokens), "ids": ids}
        )
    return _coded(docs, vocabulary, pattern, columns, digests)


def op2_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encoded_digests(documents(spark, sf), vocabulary, public_tokenizers.PATTERN)
