"""One dictionary of entities over a whole corpus: an Aho-Corasick automaton
finds all entries in one pass per text."""

from __future__ import annotations

import html
import sys
import types
import uuid
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from corpuslab.session import via_table

from .cleaning import SLICE, TAG_CLASS, TAG_CLOSE, TAG_END, TAG_TITLE

#: Characters of entries that one automaton holds; longer dictionaries take several passes.
PART_CHARS = 8_000_000

MATCH = T.ArrayType(
    T.StructType(
        [
            T.StructField("start", T.IntegerType()),
            T.StructField("end", T.IntegerType()),
            T.StructField("label", T.StringType()),
        ]
    )
)


def folded(text: str) -> str:
    """Lower case letter by letter, so that places stay the same."""
    lowered = text.lower()
    if len(lowered) == len(text):
        return lowered
    return "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def entries_of(entities: DataFrame) -> DataFrame:
    """Different entity texts, lower case, each with one label: that of the most
    confident entity, then the first label. Empty texts are left out."""
    confidence = F.col("confidence").cast("double") if "confidence" in entities.columns else F.lit(0.0)
    known = entities.filter(F.length("text") > 0)
    choice = F.struct((-F.coalesce(confidence, F.lit(0.0))).alias("less"), F.col("label").alias("label"))
    return known.groupBy(F.lower("text").alias("text")).agg(F.min(choice)["label"].alias("label"))


def part_count(entries: DataFrame, part_chars: int) -> int:
    size = entries.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    return 1 if size <= part_chars else -(-2 * size // part_chars)


def part_of(entries: DataFrame, part: int, parts: int) -> list[tuple[str, str]]:
    """The entries of one part, whose size is bounded."""
    chosen = entries.filter(F.pmod(F.xxhash64("text"), F.lit(parts)) == part) if parts > 1 else entries
    return [(r["text"], r["label"]) for r in chosen.collect()]


def automaton_of(key: str, rows: list[tuple[str, str]]):
    """Built once per Python worker; a worker keeps the last one only."""
    holder = sys.modules.setdefault("_dictionary", types.ModuleType("_dictionary"))
    if getattr(holder, "key", None) != key:
        import ahocorasick

        machine = ahocorasick.Automaton()
        for text, label in rows:
            text = folded(text)
            machine.add_word(text, (len(text), label))
        machine.make_automaton()
        holder.key, holder.machine = key, machine
    return holder.machine


def longest_at(machine, text: str) -> dict[int, tuple[int, str]]:
    """For each place where entries begin the end of the longest, and its label."""
    best: dict[int, tuple[int, str]] = {}
    for last, (size, label) in machine.iter(folded(text)):
        start = last + 1 - size
        if start not in best or best[start][0] < last + 1:
            best[start] = (last + 1, label)
    return best


def leftmost(found: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Of overlapping matches the first, of those that begin together the longest."""
    out, at = [], 0
    for start, end, label in sorted(found, key=lambda m: (m[0], -m[1], m[2])):
        if start >= at:
            out.append((start, end, label))
            at = end
    return out


def leftmost_of(longest: dict[int, tuple[int, str]]) -> list[tuple[int, int, str]]:
    """``leftmost`` of what ``longest_at`` found, one match for each place."""
    out, at = [], 0
    for start in sorted(longest):
        if start >= at:
            at, label = longest[start]
            out.append((start, at, label))
    return out


def dictionary_matches(docs: DataFrame, entities: DataFrame, text: str = "text", part_chars: int = PART_CHARS) -> DataFrame:
    """``docs`` with ``matches``: start, end (code points, end exclusive) and
    label of each entry found in the text, case-insensitively, leftmost and
    longest first, without overlaps. Null texts have none.

    A dictionary of more than ``part_chars`` characters is searched for in
    several passes, each with one part; the last one chooses among all matches.
    """
    entries = via_table(entries_of(entities), "dictionary")
    found = docs.withColumn("matches", F.when(F.lit(True), F.array().cast(MATCH)))
    parts = part_count(entries, part_chars)
    for part in range(parts):
        if part:
            found = via_table(found, "dictionary-part")
        search = _searcher(part_of(entries, part, parts), text, uuid.uuid4().hex, part == parts - 1)
        found = found.mapInArrow(search, found.schema)
    return found


def _with_matches(batch: pa.RecordBatch, matches: list) -> pa.RecordBatch:
    at = batch.schema.get_field_index("matches")
    kind = batch.schema.field(at).type
    fields, each = list(kind.value_type), list(zip(*chain.from_iterable(matches), strict=True)) or [()] * 3
    flat = pa.StructArray.from_arrays([pa.array(v, f.type) for v, f in zip(each, fields, strict=True)], fields=fields)
    ends = pa.array(np.cumsum([0, *map(len, matches)]), pa.int32())
    columns = [pa.ListArray.from_arrays(ends, flat, kind) if i == at else c for i, c in enumerate(batch.columns)]
    return pa.RecordBatch.from_arrays(columns, schema=batch.schema)


def _known(batch: pa.RecordBatch) -> list[list[tuple[int, int, str]]]:
    rows = batch.column(batch.schema.get_field_index("matches")).to_pylist()
    return [[(m["start"], m["end"], m["label"]) for m in own] for own in rows]


def _searcher(rows: list[tuple[str, str]], column: str, key: str, last: bool):
    def run(batches):
        machine = automaton_of(key, rows) if rows else None
        for batch in (whole.slice(at, SLICE) for whole in batches for at in range(0, whole.num_rows, SLICE)):
            texts = batch.column(batch.schema.get_field_index(column)).to_pylist()
            matches = []
            for text, before in zip(texts, _known(batch), strict=True):
                longest = longest_at(machine, text) if text and machine else {}
                if last and not before:
                    matches.append(leftmost_of(longest))
                else:
                    every = before + [(s, e, label) for s, (e, label) in longest.items()]
                    matches.append(leftmost(every) if last else every)
            yield _with_matches(batch, matches)

    return run


def tagged(text: str, matches: list[tuple[int, int, str]]) -> str:
    """The text, HTML-escaped, with every match in a tag that names its label."""
    out, at = [], 0
    for start, end, label in matches:
        out += [html.escape(text[at:start], quote=False), TAG_CLASS, label, TAG_TITLE, label, TAG_END]
        out += [html.escape(text[start:end], quote=False), TAG_CLOSE]
        at = end
    return "".join(out) + html.escape(text[at:], quote=False)


def annotate_corpus(docs: DataFrame, entities: DataFrame, text: str = "text", part_chars: int = PART_CHARS) -> DataFrame:
    """``docs`` with ``annotated``: the text with every entry of the one
    dictionary of ``entities`` in a tag, wherever it occurs."""
    found = dictionary_matches(docs, entities, text, part_chars)
    out = T.StructType([*docs.schema.fields, T.StructField("annotated", T.StringType())])

    def run(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            done = [None if t is None else tagged(t, m) for t, m in zip(texts, _known(batch), strict=True)]
            columns = [c for c, name in zip(batch.columns, batch.schema.names, strict=True) if name != "matches"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(done, pa.string())], names=out.names)

    return found.mapInArrow(run, out)
