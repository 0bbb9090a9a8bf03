"""Words of a batch of texts as arrays: places and 64-bit hashes.

Bytes are folded by a table (zero: between words). The hash of a word is the
difference of two prefix sums of bytes times powers of an odd number, brought
to a common exponent by the inverse powers; all sums wrap at 64 bits.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Fixed value: an odd multiplier.
BASE = 0x9E3779B97F4A7C15
MIX = np.uint64(0xFF51AFD7ED558CCD)
RUN = 1 << 20

#: Lower case for A-Z; bytes of words are 0-9, a-z and all beyond ASCII.
FOLD = np.array(
    [b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 0 for b in range(256)], np.uint8
)


def powers(base: int, count: int) -> np.ndarray:
    """base ** 0 .. count - 1 modulo 2 ** 64, by doubling."""
    out = np.ones(count, np.uint64)
    done, step = 1, base
    while done < count:
        more = min(done, count - done)
        out[done : done + more] = out[:more] * np.uint64(step)
        done, step = done + more, step * step % (1 << 64)
    return out


class Powers:
    """Powers of the multiplier and of its inverse, grown on demand."""

    def __init__(self):
        self.up, self.down = powers(BASE, 1), powers(1, 1)

    def get(self, count: int) -> tuple[np.ndarray, np.ndarray]:
        if count > len(self.up):
            size = 1 << (count - 1).bit_length()
            self.up, self.down = powers(BASE, size), powers(pow(BASE, -1, 1 << 64), size)
        return self.up, self.down


@dataclass
class Words:
    """Words of several texts: folded bytes, byte places, hashes, and the
    number of the first word of each text."""

    folded: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    def text(self, i: int) -> bytes:
        return self.folded[self.start[i] : self.end[i]].tobytes()


def words_of(texts: list[str], held: Powers, fold: np.ndarray = FOLD) -> Words:
    """Words are runs of bytes that ``fold`` does not map to zero."""
    raw = [t.encode() for t in texts]
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    # A zero after each text keeps words of neighbours apart.
    folded = fold[np.frombuffer(b"\0".join(raw) + b"\0", np.uint8)]
    inside = np.concatenate([[False], folded != 0, [False]]).view(np.int8)
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edges[::2], edges[1::2]
    begins = np.cumsum(sizes + 1) - (sizes + 1)
    first = np.append(np.searchsorted(start, begins), len(start))
    hashes = np.zeros(len(start), np.uint64)
    # Runs of bytes, cut between words, so that the tables of powers stay small.
    at = 0
    while at < len(start):
        origin = start[at]
        to = max(at + 1, int(np.searchsorted(end, origin + RUN, side="right")))
        up, down = held.get(int(end[to - 1] - origin) + 1)
        part = folded[origin : end[to - 1]]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * up[: len(part)], out=sums[1:])
        s, e = start[at:to] - origin, end[at:to] - origin
        hashes[at:to] = (sums[e] - sums[s]) * down[s]
        at = to
    hashes ^= hashes >> np.uint64(32)
    hashes *= MIX
    hashes ^= hashes >> np.uint64(29)
    return Words(folded, start, end, hashes, first)


class Lookup:
    """Numbers of known hashes; ``missing`` for others."""

    def __init__(self, hashes: np.ndarray, missing: int):
        bits = max(8, int(4 * max(1, len(hashes))).bit_length())
        self.shift, self.missing = np.uint64(64 - bits), missing
        order = np.argsort(hashes, kind="stable")
        self.sorted, self.number = np.append(hashes[order], np.uint64(0)), np.append(order, missing).astype(np.int32)
        slots = (hashes[order] >> self.shift).astype(np.int64)
        self.begin = np.searchsorted(slots, np.arange(1 << bits)).astype(np.int32)
        self.deepest = int(np.bincount(slots, minlength=1).max()) if len(hashes) else 0

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        at = self.begin[(hashes >> self.shift).astype(np.int64)]
        found = np.full(len(hashes), self.missing, np.int32)
        for step in range(self.deepest):
            place = np.minimum(at + step, len(self.sorted) - 1)
            found = np.where(self.sorted[place] == hashes, self.number[place], found)
        return found
