"""Token labels, entity spans and silver-label records.

A labelled document is one row with ``tokens``, an array of
(position, token, label_id, confidence). A document's tokens come from one
text, so decoding inside the row needs no shuffle; ``*_rows`` variants take and
give one row per token.
"""

from __future__ import annotations

import hashlib
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from corpuslab.functions.arrays import let, once, rows_of, tail

from .scan import Running, running

# Tag vocabulary (id = position), special tokens, limits.
LABELS = ["O", "B-Chemical", "I-Chemical", "B-Disease", "I-Disease"]
SPECIAL_TOKENS = ["[CLS]", "[SEP]", "[PAD]"]
CONFIDENCE_THRESHOLD = 0.85
MAX_TOKENS = 128
MAX_DOCUMENT_TOKENS = 512
IGNORE = -100

MODELS_PER_WORKER = 2
#: Characters of the texts that a worker labels at a time; tokens as Python objects take many times their room.
PART_CHARS = 500_000

ENTITY_TYPES = [name[2:] for name in LABELS if name.startswith("B-")]
BEGIN_IDS = [i for i, name in enumerate(LABELS) if name.startswith("B-")]
INSIDE_IDS = [i for i, name in enumerate(LABELS) if name.startswith("I-")]

TOKEN = T.StructType(
    [
        T.StructField("position", T.IntegerType()),
        T.StructField("token", T.StringType()),
        T.StructField("label_id", T.IntegerType()),
        T.StructField("confidence", T.DoubleType()),
    ]
)

Predictor = Callable[[list[str]], list[list[tuple[str, int, float]]]]


def label_name(label_id: Column) -> Column:
    return F.get(F.array([F.lit(x) for x in LABELS]), label_id)


def entity_type(label_id: Column) -> Column:
    return F.substring(label_name(label_id), 3, 100)


def worker_model(key: str, factory: Callable[[], Predictor]) -> Predictor:
    """The model of ``key`` in this worker, built where it is not there yet.
    Functions reach the workers by value, so it hangs on a module of its own; a
    worker keeps the last ``MODELS_PER_WORKER``."""
    models = sys.modules.setdefault("_worker_models", types.ModuleType("_worker_models")).__dict__
    held = models.setdefault("held", {})
    if key not in held:
        while len(held) >= MODELS_PER_WORKER:
            del held[next(iter(held))]
        held[key] = factory()
    return held[key]


def predicted(predict: Predictor, texts: list[str], batch_size: int) -> list:
    """What ``predict`` gives for each text, asked in batches by length."""
    order = sorted(range(len(texts)), key=lambda i: (len(texts[i] or ""), i))
    out: list = [None] * len(texts)
    for at in range(0, len(order), batch_size):
        some = order[at : at + batch_size]
        for i, found in zip(some, predict([texts[i] for i in some]), strict=True):
            out[i] = found
    return out


def parts_of(batch: pa.RecordBatch, text: str = "text", chars: int = PART_CHARS) -> Iterator[pa.RecordBatch]:
    """The rows of ``batch`` in parts whose texts begin within the same ``chars`` bytes."""
    lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    part = (np.cumsum(lengths, dtype=np.int64) - lengths) // chars
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
        if begin < end:
            yield batch.slice(begin, end - begin)


def predict_tokens(
    df: DataFrame,
    predictor_factory: Callable[[], Predictor],
    doc_id: str = "doc_id",
    text: str = "text",
    batch_size: int = 16,
) -> DataFrame:
    """Label every text with a model that is built once per Python worker, and
    stays in it for later tasks.

    ``predictor_factory()`` returns a function from a list of texts to, per
    text, (token, label id, confidence) triples. Texts of similar length share
    a batch, so that little is padded. Confidences are rounded to 4 places.
    Rows stay in their partitions; a worker holds the tokens of about
    ``PART_CHARS`` characters at a time.
    """
    made = hashlib.sha256(cloudpickle.dumps(predictor_factory)).hexdigest()

    source = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = T.StructType([source.schema["doc_id"], T.StructField("tokens", T.ArrayType(TOKEN))])
    kinds = to_arrow_schema(schema)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = worker_model(made, predictor_factory)
        fields = list(kinds.field("tokens").type.value_type)
        for batch in (part for whole in batches for part in parts_of(whole)):
            texts = batch.column("text").to_pylist()
            found = predicted(predict, texts, batch_size)
            ends = np.cumsum([0, *map(len, found)])
            position = np.arange(ends[-1]) - np.repeat(ends[:-1], np.diff(ends))
            flat = [t for doc in found for t in doc]
            columns = [
                position,
                [token for token, _, _ in flat],
                [label_id for _, label_id, _ in flat],
                [round(confidence, 4) for _, _, confidence in flat],
            ]
            arrays = [pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)]
            tokens = pa.ListArray.from_arrays(
                pa.array(ends, pa.int32()), pa.StructArray.from_arrays(arrays, fields=fields), kinds.field("tokens").type
            )
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), tokens], schema=kinds)

    return source.mapInArrow(label, schema)


def token_rows(labelled: DataFrame) -> DataFrame:
    return rows_of(labelled, [c for c in labelled.columns if c != "tokens"], "tokens")


def truncate(tokens: Column, limit: int = MAX_TOKENS) -> Column:
    return F.slice(tokens, 1, limit)


def predicted_class(logits: Column) -> Column:
    """Index of the largest logit, the first one on ties."""
    return (F.array_position(logits, F.array_max(logits)) - 1).cast("int")


def predicted_probability(logits: Column) -> Column:
    """Softmax probability of the largest logit."""
    total = F.aggregate(
        F.transform(logits, lambda x: F.exp(x.cast("double") - F.array_max(logits))), F.lit(0.0), lambda a, x: a + x
    )
    return 1 / total


def drop_special(tokens: Column, special: list[str] = SPECIAL_TOKENS) -> Column:
    return F.filter(tokens, lambda t: ~t["token"].isin(special))


def demote(tokens: Column, threshold: float = CONFIDENCE_THRESHOLD) -> Column:
    """Tag ids with uncertain ones set to O, token by token."""
    return F.transform(tokens, lambda t: demoted_id(t["label_id"], t["confidence"], threshold))


def demoted_id(label_id: Column, confidence: Column, threshold: float = CONFIDENCE_THRESHOLD) -> Column:
    return F.when((label_id != 0) & (F.round(confidence, 4) < threshold), 0).otherwise(label_id)


def join_pieces(tokens: Column) -> Column:
    return F.array_join(F.transform(tokens, lambda t: F.replace(t, F.lit("##"), F.lit(""))), "")


def decode_spans(labelled: DataFrame, strict: bool = False) -> DataFrame:
    """Add ``spans``, an array of (text, label, start, end, confidence).

    B- starts a span; I- extends an open one whatever its type and is ignored
    when none is open; O closes. Special tokens are invisible. ``strict`` also
    closes at an I- of another type.

    Tokens other than I- are marks. A span is a B- mark with the tokens up to
    the next mark, so all spans are slices between neighbouring marks.
    """
    return once(labelled, spans=let(drop_special(F.col("tokens")), lambda seen: _spans(seen, strict)))


def _spans(seen: Column, strict: bool) -> Column:
    def is_mark(t: Column, i: Column) -> Column:
        mark = ~t["label_id"].isin(INSIDE_IDS)
        if not strict:
            return mark
        before = F.get(seen, i - 1)["label_id"]
        return mark | ~entity_type(t["label_id"]).eqNullSafe(entity_type(before))

    numbered = F.transform(
        seen, lambda t, i: F.when(is_mark(t, i), F.struct(i.alias("at"), t["label_id"].alias("label_id")))
    )
    return let(F.filter(numbered, lambda m: m.isNotNull()), lambda marks: _between(seen, marks))


def _between(seen: Column, marks: Column) -> Column:
    ends = F.concat(F.transform(tail(marks), lambda m: m["at"]), F.array(F.size(seen)))
    bounded = F.zip_with(
        marks, ends, lambda m, end: F.struct(m["label_id"].alias("label_id"), m["at"].alias("at"), end.alias("end"))
    )

    def span(b: Column) -> Column:
        return let(
            F.slice(seen, b["at"] + 1, b["end"] - b["at"]),
            lambda parts: F.struct(
                join_pieces(F.transform(parts, lambda p: p["token"])).alias("text"),
                entity_type(b["label_id"]).alias("label"),
                F.get(parts, F.lit(0))["position"].alias("start"),
                F.get(parts, F.size(parts) - 1)["position"].alias("end"),
                F.round(F.array_min(F.transform(parts, lambda p: p["confidence"])), 4).alias("confidence"),
            ),
        )

    return F.transform(F.filter(bounded, lambda b: b["label_id"].isin(BEGIN_IDS)), span)


def span_rows(decoded: DataFrame) -> DataFrame:
    """One row per span; columns other than the arrays are kept."""
    kept = [c for c in decoded.columns if c not in ("tokens", "spans")]
    return rows_of(decoded, kept, "spans")


def decode_token_rows(rows: DataFrame, keys: list[str], group_rows: int | None = None) -> DataFrame:
    """Spans from one row per token, for sequences of any length.

    The running number of non-I- tokens names the stretch a token belongs to;
    it is scanned in blocks, so one long sequence does not end in one task.
    """
    seen = rows.filter(~F.col("token").isin(SPECIAL_TOKENS))
    is_mark = ~F.col("label_id").isin(INSIDE_IDS)
    numbered = Running("_stretch", "sum", F.when(is_mark, 1).otherwise(0).cast("bigint"))
    begun = Running("_begin", "last", F.when(is_mark, F.col("label_id")))
    # Only what follows a B- token is gathered; ignored tokens are not, however many they are.
    known = running(seen, keys, ["position"], [numbered, begun], group_rows).filter(F.col("_begin").isin(BEGIN_IDS))
    parts = F.array_sort(F.collect_list(F.struct("position", "token")))
    return (
        known.groupBy(*keys, "_stretch")
        .agg(
            F.min_by("label_id", "position").alias("_first"),
            join_pieces(parts["token"]).alias("text"),
            F.min("position").alias("start"),
            F.max("position").alias("end"),
            F.round(F.min("confidence"), 4).alias("confidence"),
        )
        .filter(F.col("_first").isin(BEGIN_IDS))
        .select(*keys, "text", entity_type(F.col("_first")).alias("label"), "start", "end", "confidence")
    )


def confident(spans: Column, threshold: float = CONFIDENCE_THRESHOLD) -> Column:
    return F.filter(spans, lambda s: s["confidence"] >= threshold)


def mean_of_four_places(values: Column) -> Column:
    """Mean of numbers with at most 4 places, rounded half up to 4 places.

    Summed as integers, so that the order of the values cannot matter."""
    total = F.aggregate(
        F.transform(values, lambda v: F.round(v * 10_000).cast("bigint")),
        F.lit(0).cast("bigint"),
        lambda a, v: a + v,
    )
    n = F.size(values)
    return F.when(n > 0, F.floor((total * 2 + n) / (n * 2)) / 10_000).otherwise(0.0)


def silver_labels(decoded: DataFrame, threshold: float = CONFIDENCE_THRESHOLD) -> DataFrame:
    """tokens, tags, num_entities and avg_confidence per document; a document
    without confident spans has 0 of both."""
    good = decoded.withColumn("_good", confident(F.col("spans"), threshold)).withColumn(
        "_seen", drop_special(F.col("tokens"))
    )
    return good.select(
        "doc_id",
        F.col("_seen")["token"].alias("tokens"),
        demote(F.col("_seen"), threshold).alias("tags"),
        F.size("_good").alias("num_entities"),
        mean_of_four_places(F.col("_good")["confidence"]).alias("avg_confidence"),
    )


def label_report(decoded: DataFrame, threshold: float = CONFIDENCE_THRESHOLD) -> DataFrame:
    """Totals over all documents and the confident spans per entity type."""
    good = confident(F.col("spans"), threshold)

    def of_type(name: str) -> Column:
        return F.sum(F.size(F.filter(good, lambda s: s["label"] == name)))

    totals = decoded.agg(
        F.count(F.lit(1)).alias("total_abstracts"),
        F.coalesce(F.sum(F.size("spans")), F.lit(0)).alias("total_entities"),
        F.coalesce(F.sum(F.size(good)), F.lit(0)).alias("high_confidence_entities"),
        *[F.coalesce(of_type(name), F.lit(0)).alias(f"_{name}") for name in ENTITY_TYPES],
    )
    counts = [c for name in ENTITY_TYPES for c in (F.lit(name), F.col(f"_{name}"))]
    rate = F.col("high_confidence_entities") / F.greatest("total_entities", F.lit(1))
    return totals.select(
        "total_abstracts",
        "total_entities",
        "high_confidence_entities",
        (rate * 100).alias("filter_rate_pct"),
        F.create_map(*counts).alias("entity_counts"),
    )


def document_summary(decoded: DataFrame) -> DataFrame:
    """num_tokens, entities_found and entities per type of each document."""
    labels = F.transform("spans", lambda s: s["label"])
    counts = F.transform(
        F.array_sort(F.array_distinct(labels)),
        lambda x: F.struct(x.alias("label"), F.size(F.filter(F.col("spans"), lambda s: s["label"] == x)).alias("n")),
    )
    return decoded.select(
        "doc_id",
        F.size("tokens").alias("num_tokens"),
        F.size("spans").alias("entities_found"),
        F.map_from_entries(counts).alias("entity_summary"),
    )


def span_agreement(df: DataFrame, a: str = "spans_a", b: str = "spans_b") -> DataFrame:
    """Span agreement of two models in the row: spans of each, and spans in both,
    only A, only B, with zeros where no model found any. A span is its start,
    end and label."""

    def spots(spans: str) -> Column:
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["label"].alias("label")))

    def number(s: Column) -> Column:
        """Start (31 bits), length (24) and label (8) as one number, null where they do not fit."""
        label = F.array_position(F.array(*[F.lit(x) for x in ENTITY_TYPES]), s["label"]).cast("bigint")
        length = s["end"].cast("bigint") - s["start"]
        fits = (label > 0) & (s["start"] >= 0) & length.between(0, (1 << 24) - 1)
        return F.when(fits, F.shiftleft(F.shiftleft(s["start"].cast("bigint"), 24) + length, 8) + label)

    numbered = once(df, _a=F.transform(a, number), _b=F.transform(b, number))
    plain = ~F.exists("_a", lambda n: n.isNull()) & ~F.exists("_b", lambda n: n.isNull())
    # Numbers are compared by hash; structs would be compared pair by pair.
    common = F.when(plain, F.size(F.array_intersect("_a", "_b"))).otherwise(F.size(F.array_intersect(spots(a), spots(b))))
    both = once(numbered, _both=common)
    kept = [c for c in df.columns if c not in (a, b)]
    return both.select(
        *kept,
        F.size(a).alias("entities_a"),
        F.size(b).alias("entities_b"),
        F.col("_both").alias("both"),
        (F.size(a) - F.col("_both")).alias("only_a"),
        (F.size(b) - F.col("_both")).alias("only_b"),
    )


def compare_models(a: DataFrame, b: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """``span_agreement`` for predictions in two tables, one row per document
    each with ``spans``; a document that one of them lacks has no spans there."""
    keys = keys or ["doc_id"]
    sides = [df.select(*keys, F.col("spans").alias(f"spans_{name}")) for name, df in (("a", a), ("b", b))]
    none = F.array().cast(a.schema["spans"].dataType)
    both = sides[0].join(sides[1], keys, "full_outer")
    filled = both.withColumns({c: F.coalesce(F.col(c), none) for c in ("spans_a", "spans_b")})
    return span_agreement(filled)


def compare_documents(a: DataFrame, b: DataFrame) -> DataFrame:
    """Both models side by side: entities and latency per document."""
    sides = [
        df.select(
            "doc_id",
            F.size("spans").alias(f"entities_{name}"),
            F.col("latency_ms").alias(f"latency_{name}_ms"),
        )
        for name, df in (("a", a), ("b", b))
    ]
    return sides[0].join(sides[1], "doc_id", "full_outer")


def align_labels(tags: Column, word_ids: Column) -> Column:
    """Subword labels: no word gives the ignored id, the first piece of a word
    its tag, later pieces the I- form of a B- tag and else the tag."""

    def piece(word: Column, i: Column) -> Column:
        tag = F.get(tags, word)
        first = (i == 0) | ~word.eqNullSafe(F.get(word_ids, i - 1))
        inside = F.when(tag.isin(BEGIN_IDS), tag + 1).otherwise(tag)
        return F.when(word.isNull(), IGNORE).when(first, tag).otherwise(inside)

    return F.transform(word_ids, piece)


def pad(values: Column, length: int = MAX_TOKENS, filler: int = 0) -> Column:
    """Cut or fill to exactly ``length`` entries."""
    return F.slice(F.concat(values, F.array_repeat(F.lit(filler), length)), 1, length)


def attention_mask(values: Column, length: int = MAX_TOKENS) -> Column:
    return F.transform(F.sequence(F.lit(1), F.lit(length)), lambda i: F.when(i <= F.size(values), 1).otherwise(0))
