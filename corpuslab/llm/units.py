"""Texts cut where every byte-level split pattern cuts, with results per unit.

The split patterns of byte-level vocabularies end a match before any space
that is followed by a visible character. A text is therefore the sequence of
its units (a space and what follows up to the next such space), each unit is
encoded once per worker, and a text's ids are the units' ids joined.

Units are found, hashed and looked up over the bytes of many texts at a time;
only those that the worker's table lacks become strings.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Callable

import numpy as np

from .wordhash import MIX, RUN, Powers

MAX_UNITS = 2_000_000
#: What the kept units of a table may take: their ids, and about ENTRY_BYTES each besides.
TABLE_BYTES = 192 << 20
ENTRY_BYTES = 64
#: Longer units are encoded wherever they occur: in scripts without spaces a unit is a paragraph.
LONGEST_UNIT = 128
SPACE = 0x20


def starts_unit(chunk: str) -> bool:
    """Whether a space before ``chunk`` surely begins a new match."""
    return bool(chunk) and ("!" <= chunk[0] <= "~" or chunk[0].isalnum() and ord(chunk[0]) < 1 << 16)


def letters_and_digits() -> np.ndarray:
    """For each code point of up to 16 bits beyond ASCII whether it is a letter or digit."""
    return np.fromiter((c >= 128 and chr(c).isalnum() for c in range(1 << 16)), bool, 1 << 16)


class Cutter:
    """Cuts flat UTF-8 bytes into units."""

    def __init__(self):
        self.known = letters_and_digits()
        self.held = Powers()

    def starts(self, flat: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
        """First bytes of all units; every text that has bytes begins one."""
        space = np.flatnonzero(flat[:-1] == SPACE)
        byte = flat[space + 1]
        sure = (byte >= 0x21) & (byte <= 0x7E)
        wide = np.flatnonzero((byte >= 0xC2) & (byte < 0xF0))
        at = space[wide] + 1
        first = byte[wide].astype(np.int64)
        # A lead byte is followed by all of its bytes, as texts are whole.
        second, third = flat[at + 1] & 63, flat[np.minimum(at + 2, len(flat) - 1)] & 63
        code = np.where(first < 0xE0, (first & 31) << 6 | second, (first & 15) << 12 | second.astype(np.int64) << 6 | third)
        sure[wide] = self.known[code]
        begins = np.zeros(len(flat), bool)
        begins[space[sure]] = True
        # A space at the end of a text is not followed by its next text.
        begins[text_starts[1:] - 1] = False
        begins[text_starts] = True
        return np.flatnonzero(begins)

    def hashes(self, flat: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hashes of flat[start:end], never zero; sums wrap at 64 bits."""
        out = np.zeros(len(start), np.uint64)
        at = 0
        # Runs of bytes, cut between units, so that the tables of powers stay small.
        while at < len(start):
            origin = start[at]
            to = max(at + 1, int(np.searchsorted(end, origin + RUN, side="right")))
            up, down = self.held.get(int(end[to - 1] - origin) + 1)
            part = flat[origin : end[to - 1]].astype(np.uint64) + np.uint64(1)
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(part * up[: len(part)], out=sums[1:])
            s, e = start[at:to] - origin, end[at:to] - origin
            out[at:to] = (sums[e] - sums[s]) * down[s]
            at = to
        out ^= out >> np.uint64(32)
        out *= MIX
        out ^= out >> np.uint64(29)
        return np.maximum(out, np.uint64(1))


def worker_table(name: str) -> dict:
    """A dictionary that tasks of one Python worker share. Functions reach the
    workers by value, so it hangs on a module of its own."""
    holder = sys.modules.setdefault("_unit_tables", types.ModuleType("_unit_tables"))
    return holder.__dict__.setdefault(name, {})


def beginnings(flat: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The first eight bytes and the length, so that units that differ there
    are never taken for each other whatever their hashes."""
    padded = np.concatenate([flat, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(flat) + 1,), "<u8", padded, strides=(1,))
    size = end - start
    kept = (np.uint64(1) << (8 * np.minimum(size, 7)).astype(np.uint64)) - np.uint64(1)
    return np.where(size >= 8, eight[start], eight[start] & kept) ^ (size.astype(np.uint64) << np.uint64(48))


class UnitCoder:
    """Encodes texts through a bounded table of units.

    ``encode`` takes a list of strings and returns the packed ids of each, of
    ``width`` bytes an id. ``table`` (plain arrays by name) keeps the units seen
    first, at most ``max_units`` and ``max_bytes``; further ones are encoded
    once for each call. Texts for which ``undivided`` holds are encoded in one
    piece.
    """

    def __init__(
        self,
        encode: Callable[[list[str]], list[bytes]],
        width: int,
        table: dict | None = None,
        max_units: int = MAX_UNITS,
        max_bytes: int = TABLE_BYTES,
        undivided: Callable[[str], bool] = lambda text: False,
    ):
        self.encode, self.width, self.max_units, self.max_bytes = encode, width, max_units, max_bytes
        self.undivided, self.cut = undivided, Cutter()
        self.table = {} if table is None else table
        if not self.table:
            self.table.update(
                slots=np.zeros(1 << 12, np.uint64), numbers=np.zeros(1 << 12, np.int32), units=0, used=0,
                hash=np.zeros(1 << 10, np.uint64), begins=np.zeros(1 << 10, np.uint64),
                first=np.zeros(1 << 10, np.int64), size=np.zeros(1 << 10, np.int32), ids=np.zeros(1 << 12, f"<u{width}"),
            )

    @property
    def bytes(self) -> int:
        return ENTRY_BYTES * self.table["units"] + self.width * self.table["used"]

    def numbers_of(self, hashes: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Numbers of units in the table, -1 for others."""
        table = self.table
        slots, numbers = table["slots"], table["numbers"]
        mask = np.uint64(len(slots) - 1)
        out = np.full(len(hashes), -1, np.int64)
        place = hashes & mask
        open_ = np.arange(len(hashes))
        while len(open_):
            held = slots[place]
            same = held == hashes[open_]
            found = numbers[place[same]].astype(np.int64)
            equal = table["begins"][found] == begins[open_[same]]
            out[open_[same]] = np.where(equal, found, -1)
            more = (held != 0) & ~same
            open_, place = open_[more], (place[more] + np.uint64(1)) & mask
        return out

    def keep(self, hashes: np.ndarray, first: int) -> None:
        """Enter units numbered from ``first`` on into the slots. Of units of one
        hash the slots know one; the others count as new wherever they occur."""
        table = self.table
        total = first + len(hashes)
        if 2 * total > len(table["slots"]):
            size = 1 << (4 * total - 1).bit_length()
            table["slots"], table["numbers"] = np.zeros(size, np.uint64), np.zeros(size, np.int32)
            hashes, first = table["hash"][:total], 0
        slots, mask = table["slots"], np.uint64(len(table["slots"]) - 1)
        place, open_ = hashes & mask, np.arange(len(hashes))
        while len(open_):
            free = slots[place] == 0
            slots[place[free]] = hashes[open_[free]]
            mine = slots[place] == hashes[open_]  # of several for one slot, one wins
            table["numbers"][place[mine]] = first + open_[mine]
            open_, place = open_[~mine], (place[~mine] + np.uint64(1)) & mask

    def grown(self, name: str, count: int) -> np.ndarray:
        """The array ``name`` with room for ``count``."""
        held = self.table[name]
        if len(held) < count:
            held = self.table[name] = np.concatenate([held, np.zeros(max(count - len(held), len(held)), held.dtype)])
        return held

    def ids_of(self, flat: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each unit the first of its ids in the array of all ids, and how
        many they are; units beyond the table stand behind it for this call."""
        table = self.table
        hashes, begins = self.cut.hashes(flat, start, end), beginnings(flat, start, end)
        number = self.numbers_of(hashes, begins)
        new = np.flatnonzero(number < 0)
        _, one, same = np.unique(hashes[new], return_index=True, return_inverse=True)
        if (begins[new][one][same] != begins[new]).any():  # different units of one hash
            pairs = np.stack([hashes[new], begins[new]], axis=1)
            _, one, same = np.unique(pairs, axis=0, return_index=True, return_inverse=True)
        one = new[one]
        # Those that the table may keep come first.
        short = end[one] - start[one] <= LONGEST_UNIT
        order = np.argsort(~short, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        one = one[order]
        raw = flat.tobytes() if len(one) else b""
        packed = self.encode([raw[s:e].decode() for s, e in zip(start[one].tolist(), end[one].tolist(), strict=True)])
        sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // self.width
        units, used = table["units"], table["used"]
        behind = units + len(one)
        ends = used + np.cumsum(sizes)
        last = used + int(sizes.sum())
        self.grown("ids", last)[used:last] = np.frombuffer(b"".join(packed), f"<u{self.width}")
        for name, values in (("hash", hashes[one]), ("begins", begins[one]), ("first", ends - sizes), ("size", sizes)):
            self.grown(name, behind)[units:behind] = values
        number[new] = units + place[same]
        room = np.arange(1, len(one) + 1)
        cost = self.bytes + ENTRY_BYTES * room + self.width * (ends - used)
        kept = int(((units + room <= self.max_units) & (cost <= self.max_bytes) & short[order]).sum())
        first, size, ids = table["first"][number], table["size"][number].astype(np.int64), table["ids"]
        if kept:
            self.keep(hashes[one[:kept]], units)
            table["units"], table["used"] = units + kept, int(ends[kept - 1])
        return first, size, ids

    def __call__(self, texts: list[str]) -> list[bytes]:
        out = [b""] * len(texts)
        whole = [i for i, text in enumerate(texts) if self.undivided(text)]
        for i, ids in zip(whole, self.encode([texts[i] for i in whole]), strict=True):
            out[i] = ids
        apart = set(whole)
        left = [i for i, text in enumerate(texts) if text and i not in apart]
        if not left:
            return out
        raw = [texts[i].encode() for i in left]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        flat = np.frombuffer(b"".join(raw), np.uint8)
        begin = np.cumsum(sizes) - sizes
        start = self.cut.starts(flat, begin)
        first, size, ids = self.ids_of(flat, start, np.append(start[1:], len(flat)))
        behind = np.cumsum(size)
        gathered = ids[np.arange(int(behind[-1])) + np.repeat(first - behind + size, size)]
        before = np.append(0, behind)
        low, high = (before[np.searchsorted(start, at)].tolist() for at in (begin, begin + sizes))
        for i, a, b in zip(left, low, high, strict=True):
            out[i] = gathered[a:b].tobytes()
        return out
