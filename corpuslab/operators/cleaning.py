"""Cleaning texts and cutting records out of dumps."""

from __future__ import annotations

import html

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from corpuslab.functions import text as X
from corpuslab.functions.arrays import let, once


def clean_text(df: DataFrame, text: str = "text", keep_words: bool = False) -> DataFrame:
    """Add text_clean, text_length and word_count; keep 5 to 2000 words.

    The words come out of the same pass; ``keep_words`` keeps them as ``words``.
    """
    split = once(df.filter(X.has_text(F.col(text))), words=X.clean_words(F.col(text)))
    # An empty cleaned text counts as one (empty) word.
    counted = split.withColumn("word_count", F.greatest(F.size("words"), F.lit(1)))
    kept = counted.filter(X.words_in_range(F.col("word_count")))
    joined = kept.withColumn("text_clean", F.array_join("words", " "))
    result = joined.withColumn("text_length", F.length("text_clean"))
    return result if keep_words else result.drop("words")


def split_records(df: DataFrame, dump: str, marker: str, record: str = "record") -> DataFrame:
    """One row per piece after each ``marker``; what precedes the first is dropped."""
    pieces = F.split(F.col(dump), X.literal_pattern(marker), -1)
    return df.select(
        *[c for c in df.columns if c != dump], F.posexplode(pieces).alias("position", record)
    ).filter(F.col("position") > 0)


def extract_id(record: Column, pattern: str, prefix: str = "pmid_", default: str = "unknown") -> Column:
    found = F.regexp_extract(record, pattern, 1)
    return F.concat(F.lit(prefix), F.when(found == "", F.lit(default)).otherwise(found))


def extract_parts(record: Column, pattern: str) -> Column:
    """All parts matched by ``pattern`` joined by a space, without markup, trimmed."""
    parts = F.regexp_extract_all(record, F.lit(pattern), F.lit(1))
    return X.trim_all(X.strip_markup(F.array_join(parts, " "), ""))


# The id and the parts of a record.
ID_PATTERN = r"<PMID[^>]*>(\d+)</PMID>"
PART_PATTERN = r"(?s)<AbstractText[^>]*>(.*?)</AbstractText>"


def abstracts(
    df: DataFrame,
    dump: str = "xml",
    marker: str = "<PubmedArticle>",
    id_pattern: str = ID_PATTERN,
    part_pattern: str = PART_PATTERN,
    min_chars: int = 50,
) -> DataFrame:
    """Dump rows to (pmid, text) rows with more than ``min_chars`` characters."""
    records = split_records(df, dump, marker)
    return records.select(
        extract_id(F.col("record"), id_pattern).alias("pmid"),
        extract_parts(F.col("record"), part_pattern).alias("text"),
    ).filter(F.length("text") > min_chars)


# The tag around a highlighted entity.
TAG_CLASS, TAG_TITLE = '<span class="entity entity-', '" title="'
#: Texts whose entities are unpacked at a time.
SLICE = 200
TAG_SHARE, TAG_END, TAG_CLOSE = "% confidence", '">', "</span>"


def _keyed(found: Column, with_confidence: bool) -> Column:
    """Entities (text in lower case, less, label) in order of text, then the most confident first."""
    confidence = (lambda f: f["confidence"].cast("double")) if with_confidence else (lambda f: F.lit(0.0))
    entity = F.transform(
        F.filter(found, lambda f: F.length(f["text"]) > 0),
        lambda f: F.struct(
            F.lower(f["text"]).alias("text"), (-confidence(f)).alias("less"), f["label"].alias("label")
        ),
    )
    return F.array_sort(F.coalesce(entity, F.array().cast("array<struct<text:string,less:double,label:string>>")))


def _firsts(entities: Column) -> Column:
    """The first of the entities with one text."""
    return F.filter(entities, lambda e, i: (i == 0) | (e["text"] != F.get(entities, i - 1)["text"]))


def _tag(entity: Column, with_confidence: bool) -> Column:
    """The tag that opens before an entity; null without a label."""
    share = F.concat(F.lit(": "), F.format_string("%.1f", F.round(entity["less"] * -100, 1)), F.lit(TAG_SHARE))
    title = F.concat(entity["label"], share) if with_confidence else entity["label"]
    return F.concat(F.lit(TAG_CLASS), entity["label"], F.lit(TAG_TITLE), title, F.lit(TAG_END))


def annotate(text: Column, found: Column, with_confidence: bool = False) -> Column:
    """``text``, HTML-escaped, with every occurrence of an entity wrapped in a
    tag that names its label and, ``with_confidence``, that confidence.

    ``found`` is an array of (label, text) and, with it, confidence. All
    entities are one case-insensitive alternation, the longest first, so a
    longer one wins whatever its label, and tags never nest. Of entities with
    one text the most confident one names the label, then the first label. The
    text is split at the matches and joined again, so no character is special.
    """
    keyed = _keyed(found, with_confidence)

    def tagged(entities: Column) -> Column:
        firsts = _firsts(entities)
        names = F.map_from_arrays(F.transform(firsts, lambda e: e["text"]), firsts)
        longest_first = F.array_sort(F.transform(firsts, lambda e: F.struct((-F.length(e["text"])).alias("n"), e["text"].alias("t"))))
        choice = F.array_join(F.transform(longest_first, lambda s: X.escape_pattern(s["t"])), "|")
        # Without entities nothing matches.
        pattern = F.when(F.size(firsts) == 0, "((?!))").otherwise(F.concat(F.lit("(?iu)("), choice, F.lit(")")))
        matches = F.regexp_extract_all(text, pattern, F.lit(1))
        between = F.split(text, pattern, -1)

        def wrapped(match: Column) -> Column:
            entity = F.try_element_at(names, F.lower(match))
            inside = X.escape_html(match)
            return F.coalesce(F.concat(_tag(entity, with_confidence), inside, F.lit(TAG_CLOSE)), inside)

        parts = F.zip_with(
            between, F.transform(matches, wrapped), lambda b, m: F.concat(X.escape_html(b), F.coalesce(m, F.lit("")))
        )
        return F.array_join(parts, "")

    return let(keyed, tagged)


def folded_alike(text: str) -> str:
    """``text`` letter by letter as a pattern with the flags ``iu`` compares it."""
    if text.isascii():
        return text.lower()

    def alike(c: str) -> str:
        upper = c.upper() if len(c.upper()) == 1 else c
        return "i" if upper == "\u0130" else upper.lower()

    return "".join(alike(c) for c in text)


def wrapped(text: str, tags: dict[str, str | None]) -> str:
    """``text``, HTML-escaped, with every occurrence of a text of ``tags`` behind
    its tag: leftmost, then longest, in one pass whatever their number."""
    import ahocorasick

    machine = ahocorasick.Automaton()
    for entity in tags:
        machine.add_word(folded_alike(entity), len(entity))
    if not tags:
        return html.escape(text, quote=False)
    machine.make_automaton()
    longest: dict[int, int] = {}
    for last, size in machine.iter(folded_alike(text)):
        start = last + 1 - size
        longest[start] = max(longest.get(start, 0), last + 1)
    out, at = [], 0
    for start in sorted(longest):
        if start >= at:
            end = longest[start]
            tag, inside = tags.get(text[start:end].lower()), html.escape(text[start:end], quote=False)
            out += [html.escape(text[at:start], quote=False), inside if tag is None else tag + inside + TAG_CLOSE]
            at = end
    return "".join(out) + html.escape(text[at:], quote=False)


def annotate_text(docs: DataFrame, entities: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """``annotate`` with the entities of another table, one row each. A text is
    gone through once for all of its entities, so the time grows with the text."""
    fields = [c for c in ("label", "text", "confidence") if c in entities.columns]
    sure = "confidence" in fields
    found = entities.groupBy(doc_id).agg(F.collect_set(F.struct(*fields)).alias("_found"))
    both = docs.join(found, doc_id, "left")

    def named(keyed: Column) -> Column:
        return F.transform(_firsts(keyed), lambda e: F.struct(e["text"].alias("text"), _tag(e, sure).alias("tag")))

    named_rows = both.withColumn("_tags", let(_keyed(F.col("_found"), sure), named)).drop("_found")
    keep = [c for c in named_rows.columns if c not in ("_tags", "annotated")]
    schema = T.StructType([*[named_rows.schema[c] for c in keep], T.StructField("annotated", T.StringType())])

    def run(batches):
        for batch in (whole.slice(at, SLICE) for whole in batches for at in range(0, whole.num_rows, SLICE)):
            texts, tags = batch.column("text").to_pylist(), batch.column("_tags").to_pylist()
            done = [
                None if text is None else wrapped(text, {t["text"]: t["tag"] for t in own})
                for text, own in zip(texts, tags, strict=True)
            ]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(done, pa.string())], names=[*keep, "annotated"])

    return named_rows.select(*keep, "_tags").mapInArrow(run, schema)


def request_id(given: Column, stable: Column | None = None) -> Column:
    """The given id, else eight characters: of a random uuid, or of a hash of ``stable``."""
    made = F.substring(F.uuid() if stable is None else F.sha2(stable.cast("string"), 256), 1, 8)
    return F.coalesce(given, made)
