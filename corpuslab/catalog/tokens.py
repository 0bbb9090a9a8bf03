"""Labelled tokens made from the cleaned documents by a rule that SQL can express.

Words are cut into pieces of four letters, later pieces marked ``##``. Label
and confidence of a piece follow from its first letter and length; three
variants of the rule give the gold labels and two models.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from corpuslab.operators.cleaning import clean_text
from corpuslab.operators.labelling import TOKEN, parts_of

from . import tables as t

# Variant: (number, modulus of pieces that get the neighbouring label; 0 for none)
VARIANTS = {"gold": (0, 0), "a": (1, 11), "b": (2, 4)}


def rule_predictor():
    """The rule of variant gold in Python, as a model for ``predict_tokens``."""

    def piece(token: str) -> tuple[str, int, float]:
        if token in ("[CLS]", "[SEP]", "[PAD]"):
            return token, 0, 0.99
        base = token.replace("##", "")
        code = ord(base[0])
        if token.startswith("##"):
            label = (2, 4, 0)[code % 3]
        else:
            label = (1, 3, 2, 0, 0)[code % 5]
        return token, label, (50 + (code * 7 + len(base) * 13) % 50) / 100

    def predict(texts: list[str]) -> list[list[tuple[str, int, float]]]:
        out = []
        for text in texts:
            cut = ["[CLS]"]
            for word in text.split(" "):
                cut += [("##" if i else "") + word[i : i + 4] for i in range(0, len(word), 4)]
            out.append([piece(token) for token in [*cut, "[SEP]"]])
        return out

    return predict


def word_arrays(spark: SparkSession, sf: str) -> DataFrame:
    return clean_text(t.documents(spark, sf), keep_words=True).select("doc_id", "source", "words")


def cut_pieces(texts: pa.StringArray) -> tuple[np.ndarray, pa.StringArray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The pieces of cleaned texts, one after the other: where each text ends,
    then per piece its token, first letter, length, whether it continues a word,
    and whether it is special. Cleaned texts are ASCII, so bytes are letters."""
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    ends = ends - ends[0]
    place = np.arange(len(data))
    opens = np.zeros(len(data), bool)
    opens[ends[:-1][ends[:-1] < len(data)]] = True
    space = data == 32
    opens[1:] |= space[:-1]
    within = place - np.maximum.accumulate(np.where(opens, place, 0))
    first = np.flatnonzero(~space & (within % 4 == 0))
    # A piece ends at the next one, or at the space before it.
    letters = np.append(0, np.cumsum(~space))
    size = np.diff(np.append(letters[first], letters[-1]))
    each = np.diff(np.searchsorted(first, ends))
    last = np.cumsum(each + 2)
    special = np.zeros(len(first) + 2 * len(texts), bool)
    special[last - 1] = special[last - each - 2] = True
    plain = np.flatnonzero(~special)

    def filled(values: np.ndarray, other: int) -> np.ndarray:
        out = np.full(len(special), other, np.int64)
        out[plain] = values
        return out

    size, code, later = filled(size, 5), filled(data[first], 0), filled(within[first] > 0, 0).astype(bool)
    offsets = np.append(0, np.cumsum(size + 2 * later))
    token = np.full(offsets[-1], ord("#"), np.uint8)
    for text, at in (("[CLS]", last - each - 2), ("[SEP]", last - 1)):
        token[offsets[at][:, None] + np.arange(5)] = np.frombuffer(text.encode(), np.uint8)
    begin = (offsets[:-1] + 2 * later)[plain]
    token[np.repeat(begin - letters[first], size[plain]) + np.arange(letters[-1])] = data[~space]
    tokens = pa.StringArray.from_buffers(
        len(special), pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(token.tobytes())
    )
    return last, tokens, code, size, later, special


def _labels(variant: str, code: np.ndarray, size: np.ndarray, later: np.ndarray, special: np.ndarray) -> np.ndarray:
    """Label ids of the pieces of a batch by the rule of ``variant``."""
    _, modulus = VARIANTS[variant]
    if modulus:
        code = code + ((code + size * 3) % modulus == 0)
    found = np.where(later, np.array([2, 4, 0])[code % 3], np.array([1, 3, 2, 0, 0])[code % 5])
    return np.where(special, 0, found)


def _confidences(variant: str, code: np.ndarray, size: np.ndarray, special: np.ndarray) -> np.ndarray:
    number, _ = VARIANTS[variant]
    return np.where(special, 0.99, ((code * 7 + size * 13 + number * 3) % 50 + 50) / 100)


def _with_tokens(spark: SparkSession, sf: str, variants: dict[str, str]) -> DataFrame:
    """doc_id and, per entry of ``variants``, a column of the tokens labelled by
    that variant; the pieces are cut once for all of them."""
    source = t.cleaned(spark, sf).select("doc_id", F.col("text_clean").alias("text"))
    kind = T.ArrayType(TOKEN)
    schema = T.StructType([source.schema["doc_id"], *[T.StructField(name, kind) for name in variants]])
    kinds = to_arrow_schema(schema)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in parts_of(whole)):
            last, token, code, size, later, special = cut_pieces(batch.column("text").cast(pa.string()))
            ends = pa.array(np.append(0, last), pa.int32())
            position = np.arange(len(special)) - np.repeat(np.append(0, last[:-1]), np.diff(last, prepend=0))
            columns = []
            for name, variant in variants.items():
                fields = list(kinds.field(name).type.value_type)
                found = _labels(variant, code, size, later, special)
                values = [position, token, found, _confidences(variant, code, size, special)]
                arrays = [v if v is token else pa.array(v, f.type) for v, f in zip(values, fields, strict=True)]
                columns.append(
                    pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(arrays, fields=fields), kinds.field(name).type)
                )
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], schema=kinds)

    return source.mapInArrow(label, schema)


def labelled(spark: SparkSession, sf: str, variant: str = "gold") -> DataFrame:
    return _with_tokens(spark, sf, {"tokens": variant})


def both_labelled(spark: SparkSession, sf: str) -> DataFrame:
    """tokens_a and tokens_b of each document, out of the same pieces."""
    return _with_tokens(spark, sf, {"tokens_a": "a", "tokens_b": "b"})


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """One row per document: source and the arrays gold, pred_a, pred_b; special tokens are ignored."""
    source = t.cleaned(spark, sf).select(
        F.col("doc_id").cast("bigint").alias("sample_id"), "source", F.col("text_clean").alias("text")
    )
    names = ["sample_id", "source"]
    kind = T.ArrayType(T.IntegerType())
    arrays = {"gold": "gold", "pred_a": "a", "pred_b": "b"}
    schema = T.StructType([*[source.schema[c] for c in names], *[T.StructField(name, kind) for name in arrays]])
    kinds = to_arrow_schema(schema)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in parts_of(whole)):
            last, _, code, size, later, special = cut_pieces(batch.column("text").cast(pa.string()))
            ends = pa.array(np.append(0, last), pa.int32())
            columns = [batch.column(c) for c in names]
            for name, variant in arrays.items():
                found = _labels(variant, code, size, later, special)
                if name == "gold":
                    found = np.where(special, -100, found)
                columns.append(pa.ListArray.from_arrays(ends, pa.array(found, pa.int32()), kinds.field(name).type))
            yield pa.RecordBatch.from_arrays(columns, schema=kinds)

    return source.mapInArrow(label, schema)


def latencies(spark: SparkSession, sf: str) -> DataFrame:
    """latency_a_ms and latency_b_ms of sample n: the values of events 2n and 2n + 1."""
    events = t.table(spark, sf, "events").select("event_id", "value")
    even = F.pmod("event_id", F.lit(2)) == 0
    return events.groupBy(F.floor(F.col("event_id") / 2).alias("sample_id")).agg(
        F.max(F.when(even, F.col("value"))).alias("latency_a_ms"),
        F.max(F.when(~even, F.col("value"))).alias("latency_b_ms"),
    )


def logits(spark: SparkSession, sf: str) -> DataFrame:
    """One row per word: gold label and five logits of a teacher and a student."""
    words = word_arrays(spark, sf).select("doc_id", F.posexplode("words").alias("position", "word"))
    code, size, spot = F.ascii("word"), F.length("word"), F.col("position")

    def scores(a: int, b: int, modulus: int) -> Column:
        return F.array(
            *[((code * (k + a) + size * (k + 1) * b + spot) % modulus).cast("double") / 4 for k in range(5)]
        ).cast("array<float>")

    ignored = (code + size) % 9 == 0
    return words.select(
        F.col("doc_id").cast("bigint").alias("sample_id"),
        "position",
        F.when(ignored, -100).otherwise((code + size) % 5).alias("gold"),
        scores(3, 5, 17).alias("teacher"),
        scores(2, 3, 19).alias("student"),
    )


# ---- the same in SQL

PIECES = f"""{t.CLEAN},
pieces AS (
  SELECT doc_id, source, ['[CLS]'] || flatten(
    [[CASE WHEN i > 0 THEN '##' ELSE '' END || substr(w, 4 * i + 1, 4) for i in range((length(w) - 1) // 4 + 1)]
     for w in string_split(text_clean, ' ')]) || ['[SEP]'] AS tokens
  FROM clean),
piece_rows AS (
  SELECT doc_id, source, position, token, replace(token, '##', '') AS base,
         token IN ('[CLS]', '[SEP]', '[PAD]') AS special
  FROM (SELECT doc_id, source, unnest(tokens) AS token,
               CAST(unnest(range(len(tokens))) AS INTEGER) AS position FROM pieces))"""


def sql_label(variant: str) -> str:
    _, modulus = VARIANTS[variant]
    code = "ascii(base)"
    if modulus:
        code = f"(ascii(base) + CASE WHEN (ascii(base) + length(base) * 3) % {modulus} = 0 THEN 1 ELSE 0 END)"
    return f"""CAST(CASE WHEN special THEN 0
      WHEN token LIKE '##%' THEN CASE {code} % 3 WHEN 0 THEN 2 WHEN 1 THEN 4 ELSE 0 END
      ELSE CASE {code} % 5 WHEN 0 THEN 1 WHEN 1 THEN 3 WHEN 2 THEN 2 ELSE 0 END END AS INTEGER)"""


def sql_confidence(variant: str) -> str:
    number, _ = VARIANTS[variant]
    return f"""CASE WHEN special THEN CAST(0.99 AS DOUBLE)
      ELSE CAST(50 + (ascii(base) * 7 + length(base) * 13 + {number * 3}) % 50 AS DOUBLE) / 100 END"""


def sql_labelled(variant: str = "gold", name: str = "labelled") -> str:
    return f"""{name} AS (
  SELECT doc_id, position, token, {sql_label(variant)} AS label_id, {sql_confidence(variant)} AS confidence
  FROM piece_rows)"""


def sql_spans(variant: str = "gold", suffix: str = "") -> str:
    return f"""{sql_labelled(variant, "labelled" + suffix)},
seen{suffix} AS (SELECT * FROM labelled{suffix} WHERE token NOT IN ('[CLS]', '[SEP]', '[PAD]')),
islands{suffix} AS (
  SELECT *, sum(CASE WHEN label_id IN (2, 4) THEN 0 ELSE 1 END)
    OVER (PARTITION BY doc_id ORDER BY position ROWS UNBOUNDED PRECEDING) AS island FROM seen{suffix}),
spans{suffix} AS (
  SELECT doc_id, string_agg(replace(token, '##', ''), '' ORDER BY position) AS text,
    CASE arg_min(label_id, position) WHEN 1 THEN 'Chemical' ELSE 'Disease' END AS label,
    min(position) AS start, max(position) AS "end", round(min(confidence), 4) AS confidence
  FROM islands{suffix} GROUP BY doc_id, island HAVING arg_min(label_id, position) IN (1, 3))"""


PAIRS = f"""{PIECES},
triples AS (
  SELECT CAST(doc_id AS BIGINT) AS sample_id, source, position,
    CASE WHEN special THEN -100 ELSE {sql_label("gold")} END AS gold,
    {sql_label("a")} AS pred_a, {sql_label("b")} AS pred_b
  FROM piece_rows),
pairs AS (
  SELECT 'A' AS model, sample_id, source, position, gold, pred_a AS pred FROM triples WHERE gold <> -100
  UNION ALL
  SELECT 'B', sample_id, source, position, gold, pred_b FROM triples WHERE gold <> -100)"""

LATENCIES = """latencies AS (
  SELECT event_id // 2 AS sample_id, max(value) FILTER (event_id % 2 = 0) AS latency_a_ms,
    max(value) FILTER (event_id % 2 = 1) AS latency_b_ms
  FROM events GROUP BY 1)"""


def _sql_scores(a: int, b: int, modulus: int) -> str:
    one = [
        f"CAST((ascii(word) * {k + a} + length(word) * {(k + 1) * b} + position) % {modulus} AS DOUBLE) / 4"
        for k in range(5)
    ]
    return "[" + ", ".join(one) + "]"


LOGITS = f"""{t.CLEAN},
word_rows AS (
  SELECT doc_id, unnest(words) AS word, CAST(unnest(range(len(words))) AS INTEGER) AS position
  FROM (SELECT doc_id, string_split(text_clean, ' ') AS words FROM clean)),
logits AS (
  SELECT CAST(doc_id AS BIGINT) AS sample_id, position,
    CASE WHEN (ascii(word) + length(word)) % 9 = 0 THEN -100 ELSE (ascii(word) + length(word)) % 5 END AS gold,
    {_sql_scores(3, 5, 17)} AS teacher, {_sql_scores(2, 3, 19)} AS student
  FROM word_rows)"""
