"""Quality rules as a short-circuit cascade.

Every rule reads a lazily measured view of a text. On a sample each rule is
timed alone and its rejections are counted; rules then run in the order of
rejections per second, and a text leaves at its first rejection, so later
rules and their measurements are not computed for it. The order changes the
cost only: a text is kept if no rule rejects it.

Null and empty texts have no words and are rejected as too short; very long
texts are measured whole; rules of equal rejections per second run in the order
of their time, then their names; repeated rows are each judged; an empty table
gives no rows; other columns pass unread.
"""

from __future__ import annotations

import re
import time
from collections import Counter
from collections.abc import Callable
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import bounded_batches, documents, map_batches, sampled_texts, texts

SAMPLE_DOCS = 2_000
WINDOW = 3
SPACES = " \t\n\x0b\x0c\r"


class View:
    """Measurements of one text, each computed when first asked for."""

    symbols = re.compile(r"[#*$%&|<>]")
    white = re.compile(r"[\x20\x09-\x0D]")

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def raw(self) -> bytes:
        return self.text.encode()

    @cached_property
    def words(self) -> list[bytes]:
        return self.raw.split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, SPACES))

    @cached_property
    def n_symbols(self) -> int:
        return len(self.symbols.findall(self.text))

    @cached_property
    def lines(self) -> list[str]:
        return [line for line in self.text.split("\n") if line.strip(SPACES)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        words = self.words
        windows = list(zip(*(words[i:] for i in range(WINDOW)), strict=False))
        if len(set(windows)) == len(windows):
            return 0
        found = Counter(windows)
        covered = end = 0
        for i, window in enumerate(windows):
            if found[window] > 1:
                covered += i + WINDOW - max(i, end)
                end = i + WINDOW
        return covered


#: Rejections in integers, so that they hold exactly everywhere.
RULES: dict[str, Callable[[View], bool]] = {
    "too_few_words": lambda v: v.n_words < 50,
    "repeated_words": lambda v: 100 * v.n_repeat_words > 50 * v.n_words,
    "symbols": lambda v: 10 * v.n_symbols > v.n_words,
    "repeated_lines": lambda v: 2 * v.n_dup_lines > len(v.lines),
    "word_length": lambda v: not 2 * v.n_words <= v.word_chars <= 20 * v.n_words,
}
BASE = ("too_few_words", "repeated_words")


def estimate(docs: DataFrame, rules: dict = RULES, sample_docs: int = SAMPLE_DOCS) -> list[str]:
    """Names of ``rules``, those with most rejections per second first. About
    ``sample_docs`` documents from all parts of the table are timed."""

    def make():
        spent, rejected = dict.fromkeys(rules, 0.0), dict.fromkeys(rules, 0)

        def step(rows):
            for text in rows["text"]:
                for name, rule in rules.items():
                    began = time.perf_counter()
                    rejected[name] += bool(rule(View(text)))
                    spent[name] += time.perf_counter() - began
            return ()

        def finish():
            yield {"rule": list(rules), "seconds": list(spent.values()), "rejected": list(rejected.values())}

        step.finish = finish
        return step

    measured = map_batches(sampled_texts(docs, sample_docs), make, "rule string, seconds double, rejected bigint")
    # One row per rule.
    rows = measured.groupBy("rule").agg(F.sum("seconds").alias("s"), F.sum("rejected").alias("r")).collect()
    value = {row["rule"]: (-row["r"] / max(row["s"], 1e-9), row["s"]) for row in rows}
    return sorted(rules, key=lambda name: (value.get(name, (0.0, 0.0)), name))


def first_rejection(view: View, ordered: list[tuple[str, Callable]]) -> str | None:
    return next((name for name, rule in ordered if rule(view)), None)


def judged(docs: DataFrame, rules: dict = RULES, order: list[str] | None = None) -> DataFrame:
    """Per row: doc_id, the measurements, base_failed and kept: what fails a base
    rule is not kept, whatever ``rules`` are."""
    ordered = [(name, rules[name]) for name in order or estimate(docs, rules)]
    fields = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def make():
        def step(rows):
            views = [View(text) for text in rows["text"]]
            failed = [any(RULES[name](v) for name in BASE) for v in views]
            kept = [not f and first_rejection(v, ordered) is None for v, f in zip(views, failed, strict=True)]
            yield {
                "doc_id": rows["doc_id"],
                **{f: [getattr(v, f) for v in views] for f in fields},
                "base_failed": failed,
                "kept": kept,
            }

        return step

    measures = ", ".join(f"{f} bigint" for f in fields)
    return map_batches(texts(docs), make, f"doc_id bigint, {measures}, base_failed boolean, kept boolean")


def keep_good(docs: DataFrame, rules: dict = RULES) -> DataFrame:
    """The rows that no rule rejects, with all their columns."""
    ordered = [(name, rules[name]) for name in estimate(docs, rules)]
    bounded_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("text")).to_pylist()
            yield batch.filter(pa.array([first_rejection(View(t), ordered) is None for t in column], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op8_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return judged(documents(spark, sf))


OP8_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS i
      FROM (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d)),
counted AS (SELECT r, count(*) AS n_words, sum(length(word)) AS word_chars FROM w GROUP BY r),
triples AS (SELECT r, i, word AS a, lead(word, 1) OVER (PARTITION BY r ORDER BY i) AS b,
                   lead(word, 2) OVER (PARTITION BY r ORDER BY i) AS c FROM w),
several AS (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM triples WHERE c IS NOT NULL),
covered AS (SELECT r, count(DISTINCT i + k) AS n_repeat_words
            FROM several, (SELECT unnest([0, 1, 2]) AS k) WHERE n > 1 GROUP BY r),
lines AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
          FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d)
          WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (SELECT doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
             CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
             CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines
      FROM d LEFT JOIN counted USING (r) LEFT JOIN covered USING (r) LEFT JOIN lines USING (r)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR 2 * n_dup_lines > n_lines
            OR word_chars NOT BETWEEN 2 * n_words AND 20 * n_words) AS kept
FROM b
"""
