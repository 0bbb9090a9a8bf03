"""URL filters by a bit-parallel wildcard automaton.

Every glob is a row of states, one bit each: a start bit and one bit per
literal or class. All globs are packed one after the other into words of 64
bits, and a byte of a URL moves all of them at once: the states are shifted by
one (with carry between words) and masked by what the byte fits, and states
with a wildcard behind them stay. The URLs of a batch are simulated side by
side, the longest first, so a step touches only URLs that still have a byte.

A canonical URL is "." + host in lower case + path + query; scheme and fragment
go. In a glob ``*`` is any run without "/" and "?", ``**`` any run, ``[...]``
one byte of a class (``^`` negates, ``a-z`` is a range), and all else stands
for itself. Domain rules such as ``example.com/en/`` become the glob
``*.example.com/en/**``, which holds for the host and its subdomains.

Of the domain rules that fit, the longest decides (equal lengths: the longer
host, then the earlier rule); a URL that none fits is blocked by the first
blocking glob that fits it, and allowed otherwise.

Null URLs and URLs without "://" have an empty host and path; very long URLs
cost one step per byte; repeated rows are each judged; an empty table gives no
rows; columns besides page_id and url are not read.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
STATE_BYTES = 1 << 23
BATCH_URLS = 20_000

ALLOW, BLOCK = "allow", "block"

# The domain rules of the registered query.
DOMAIN_RULES = [
    (ALLOW, "com/"),
    (BLOCK, "example.com/en/"),
    (ALLOW, "www.example.com/en/"),
    (BLOCK, "net/es/"),
    (BLOCK, "net/fr/"),
]

#: Files that hold no text to train on.
EXTENSIONS = ["avi", "bin", "css", "exe", "gif", "gz", "ico", "jpeg", "jpg", "js", "mp3", "mp4", "png", "svg", "zip"]

#: URLs without a host, files without text, pages of a site's own machinery, repeats of pages under other names.
BLOCKED_GLOBS = [
    ".",
    ".[/?]**",
    *(f"**/*.{extension}" for extension in EXTENSIONS),
    *(f"**/*.{extension}?**" for extension in EXTENSIONS),
    "*.ads.**",
    "**/cart/**",
    "**/login",
    "**/login[/.?]**",
    "**/search?**",
    "**/wp-admin/**",
    "**[?&]utm_[a-z]*",
    "**[?&]sessionid=**",
    "**[?&]replytocom=**",
]


@dataclass(frozen=True)
class Glob:
    """``text`` in the dialect above; ``fold``: letters fit both cases."""

    text: str
    fold: bool = True


def parts_of(glob: str) -> list[tuple[str, frozenset[int]]]:
    """The glob as ("one", bytes), ("run", bytes) and ("any", all bytes)."""
    raw, at, out = glob.encode(), 0, []
    every = frozenset(range(256))
    while at < len(raw):
        byte = raw[at]
        if byte == ord("*"):
            end = at
            while end < len(raw) and raw[end] == byte:
                end += 1
            out.append(("any", every) if end - at > 1 else ("run", every - frozenset(b"/?")))
            at = end
        elif byte == ord("["):
            end = raw.find(b"]", at + 2)
            if end < 0:
                raise ValueError(f"class without end in {glob!r}")
            body = raw[at + 1 : end]
            negated = body[:1] == b"^"
            out.append(("one", every - class_of(body[1:]) if negated else class_of(body)))
            at = end + 1
        else:
            out.append(("one", frozenset([byte])))
            at += 1
    return out


def class_of(body: bytes) -> frozenset[int]:
    found: set[int] = set()
    at = 0
    while at < len(body):
        if at + 2 < len(body) and body[at + 1] == ord("-"):
            found.update(range(body[at], body[at + 2] + 1))
            at += 3
        else:
            found.add(body[at])
            at += 1
    return frozenset(found)


def folded(fits: frozenset[int]) -> frozenset[int]:
    return fits | frozenset(bytes(fits).lower()) | frozenset(bytes(fits).upper())


class Automaton:
    """All globs as one machine. ``masks[b]``: states that byte b may enter;
    ``stays[b]``: states that byte b does not leave."""

    def __init__(self, globs: Sequence[Glob]):
        rows: list[list[frozenset[int]]] = []
        loops: list[tuple[int, frozenset[int]]] = []
        self.starts, ends, bits = [], [], 0
        for glob in globs:
            self.starts.append(bits)
            row: list[frozenset[int]] = []
            for kind, fits in parts_of(glob.text):
                if kind == "one":
                    row.append(folded(fits) if glob.fold else fits)
                else:
                    loops.append((bits + len(row), fits))
            rows.append(row)
            bits += len(row) + 1
            ends.append(bits - 1)
        self.words = max(1, -(-bits // 64))
        self.masks = np.zeros((256, self.words), np.uint64)
        self.stays = np.zeros((256, self.words), np.uint64)
        self.initial = np.zeros(self.words, np.uint64)
        for start, row in zip(self.starts, rows, strict=True):
            self._set(self.initial[None], [0], start)
            for place, fits in enumerate(row, start + 1):
                self._set(self.masks, list(fits), place)
        for place, fits in loops:
            self._set(self.stays, list(fits), place)
        self.end_word = np.array(ends, np.int64) >> 6
        self.end_bit = (np.array(ends, np.int64) & 63).astype(np.uint64)

    @staticmethod
    def _set(table: np.ndarray, rows: list[int], place: int) -> None:
        table[rows, place >> 6] |= np.uint64(1 << (place & 63))

    def fits(self, flat: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether each glob fits each string; strings lie in ``flat``."""
        out = np.zeros((len(begin), len(self.end_word)), bool)
        longest = np.argsort(-length, kind="stable")
        step = max(1, STATE_BYTES // (8 * self.words))
        for at in range(0, len(longest), step):
            some = longest[at : at + step]
            states = self._run(flat, begin[some], length[some])
            out[some] = (states[:, self.end_word] >> self.end_bit) & np.uint64(1) != 0
        return out

    def _run(self, flat: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
        """States after the last byte of each string, given the longest first."""
        states = np.repeat(self.initial[None], len(begin), axis=0)
        live = np.searchsorted(-length, -np.arange(int(length[0]) if len(length) else 0), side="left")
        for place, rows in enumerate(live):
            byte = flat[begin[:rows] + place]
            now = states[:rows]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            moved &= self.masks[byte]
            now &= self.stays[byte]
            now |= moved
        return states


def literal(text: str) -> str:
    """``text`` as a glob that fits only itself."""
    return "".join(f"[{c}]" if c in "*[" else c for c in text)


def domain_glob(rule: str) -> Glob:
    host, slash, path = rule.partition("/")
    if not host or not slash or "?" in rule or "#" in rule:
        raise ValueError(f"a domain rule is host and path, not {rule!r}")
    return Glob(f"*.{literal(host.translate(str.maketrans(UPPER, LOWER)))}/{literal(path)}**", fold=False)


def url_parts(url: Column) -> tuple[Column, Column, Column]:
    """Host, path and canonical form."""
    place = F.instr(url, "://")
    rest = F.when(place > 0, F.substr(url, place + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    after = F.substr(rest, F.length(host) + 1)
    lowered = F.translate(host, UPPER, LOWER)
    path = F.regexp_extract(after, "^[^?#]*", 0)
    return lowered, path, F.concat(F.lit("."), lowered, F.regexp_extract(after, "^[^#]*", 0))


def judged(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]] = tuple(DOMAIN_RULES),
    blocked: Sequence[str] = tuple(BLOCKED_GLOBS),
) -> DataFrame:
    """page_id, host, path, the domain rule that decides (else null), the
    verdict, and blocked_by, the glob that decides (else null). The rules are the
    caller's own list, held by every task."""
    order = sorted(range(len(rules)), key=lambda i: (-len(rules[i][1]), -rules[i][1].index("/"), i))
    names = [rules[i][1] for i in order] + [None]
    actions = np.array([rules[i][0] for i in order] + [ALLOW], object)
    globs = [domain_glob(rules[i][1]) for i in order] + [Glob(g) for g in blocked]
    shown = [*blocked, None]
    page_id = pages.schema["page_id"].dataType.simpleString()

    def first(fits: np.ndarray) -> np.ndarray:
        """The first column that holds, else the number of columns."""
        return np.where(fits.any(axis=1), fits.argmax(axis=1), fits.shape[1]) if fits.shape[1] else np.zeros(len(fits), int)

    def run(batches):
        machine = Automaton(globs)
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_URLS):
                part = batch.slice(at, BATCH_URLS)
                urls = part.column("canonical").cast(pa.large_binary())
                ends = np.frombuffer(urls.buffers()[1], np.int64)[urls.offset : urls.offset + len(urls) + 1]
                flat = np.frombuffer(urls.buffers()[2], np.uint8)
                fits = machine.fits(flat, ends[:-1], np.diff(ends))
                rule, glob = first(fits[:, : len(order)]), first(fits[:, len(order) :])
                glob = np.where(rule < len(order), len(blocked), glob)
                verdict = np.where(glob < len(blocked), BLOCK, actions[rule])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("page_id"),
                        part.column("host"),
                        part.column("path"),
                        pa.array([names[i] for i in rule], pa.string()),
                        pa.array(verdict, pa.string()),
                        pa.array([shown[i] for i in glob], pa.string()),
                    ],
                    names=["page_id", "host", "path", "rule", "verdict", "blocked_by"],
                )

    host, path, canonical = url_parts(F.coalesce(F.col("url"), F.lit("")))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"), canonical.alias("canonical"))
    return parts.mapInArrow(
        run, f"page_id {page_id}, host string, path string, rule string, verdict string, blocked_by string"
    )


def op13_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return judged(spark.read.parquet(f"{sf}/pages.parquet"))


def _regex(glob: str) -> str:
    """The glob as a regular expression over lower-case URLs."""

    def piece(found: re.Match) -> str:
        text = found[0]
        if text[0] == "*":
            return ".*" if len(text) > 1 else "[^/?]*"
        return text if text[0] == "[" else re.escape(text)

    return "(?s)^" + re.sub(r"\*+|\[[^\]]+\]|[^*\[]", piece, glob) + "$"


def _sql() -> str:
    ranked = sorted(DOMAIN_RULES, key=lambda r: -len(r[1]))

    def fits(rule: str) -> str:
        host, _, path = rule.partition("/")
        return f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{path}')"

    rule = " ".join(f"WHEN {fits(name)} THEN '{name}'" for _, name in ranked)
    action = " ".join(f"WHEN '{name}' THEN '{what}'" for what, name in ranked)
    glob = " ".join(f"WHEN regexp_matches(translate(canonical, '{UPPER}', '{LOWER}'), '{_regex(g)}') THEN '{g}'" for g in BLOCKED_GLOBS)
    return f"""
WITH rests AS (
    SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), hosts AS (
    SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS written FROM rests
), parts AS (
    SELECT page_id, translate(written, '{UPPER}', '{LOWER}') AS host, substr(rest, length(written) + 1) AS after
    FROM hosts
), urls AS (
    SELECT page_id, host, regexp_extract(after, '^[^?#]*') AS path,
           '.' || host || regexp_extract(after, '^[^#]*') AS canonical
    FROM parts
), ruled AS (
    SELECT *, CASE {rule} END AS rule FROM urls
), globbed AS (
    SELECT *, CASE WHEN rule IS NULL THEN CASE {glob} END END AS blocked_by FROM ruled
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IS NOT NULL THEN CASE rule {action} END WHEN blocked_by IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict,
       blocked_by
FROM globbed
"""


OP13_SQL = _sql()
