"""Queries over labelled tokens and entity spans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpuslab.operators import labelling as lab
from corpuslab.operators.cleaning import annotate_text
from corpuslab.operators.dictionary import dictionary_matches
from corpuslab.session import scratch_path
from corpuslab.sources import sinks

from . import tables as t, tokens as tok
from .registry import registry

QUERIES, ORACLES, query = registry()

LABELLED = f"WITH {tok.PIECES}, {tok.sql_labelled()}"
SPANS = f"WITH {tok.PIECES}, {tok.sql_spans()}"
TOKEN_COLUMNS = "doc_id, position, token, label_id, confidence"


def decoded(spark: SparkSession, sf: str, variant: str = "gold") -> DataFrame:
    return lab.decode_spans(tok.labelled(spark, sf, variant))


def both_decoded(spark: SparkSession, sf: str) -> DataFrame:
    """doc_id and the spans of both models, from one pass over the pieces."""
    rows = tok.both_labelled(spark, sf)
    first = lab.decode_spans(rows.withColumnRenamed("tokens_a", "tokens")).withColumnRenamed("spans", "spans_a")
    second = first.drop("tokens").withColumnRenamed("tokens_b", "tokens")
    return lab.decode_spans(second).withColumnRenamed("spans", "spans_b").drop("tokens")


@query("n01_predict_tokens", f"{LABELLED} SELECT {TOKEN_COLUMNS} FROM labelled")
def n01(spark: SparkSession, sf: str) -> DataFrame:
    texts = t.cleaned(spark, sf).select("doc_id", "text_clean")
    return lab.token_rows(lab.predict_tokens(texts, tok.rule_predictor, text="text_clean"))


@query("n02_rule_predictor", f"{LABELLED} SELECT {TOKEN_COLUMNS} FROM labelled")
def n02(spark: SparkSession, sf: str) -> DataFrame:
    return lab.token_rows(tok.labelled(spark, sf))


@query(
    "n03_truncate_tokens",
    f"{LABELLED} SELECT {TOKEN_COLUMNS} FROM labelled WHERE position < 128",
)
def n03(spark: SparkSession, sf: str) -> DataFrame:
    return lab.token_rows(tok.labelled(spark, sf).withColumn("tokens", lab.truncate(F.col("tokens"))))


@query(
    "n04_argmax_probability",
    f"""WITH {tok.LOGITS}
    SELECT sample_id, position, CAST(list_position(teacher, list_max(teacher)) - 1 AS INTEGER) AS label_id,
      round(1 / list_sum([exp(x - list_max(teacher)) for x in teacher]), 6) AS confidence FROM logits""",
)
def n04(spark: SparkSession, sf: str) -> DataFrame:
    logits = F.col("teacher")
    return tok.logits(spark, sf).select(
        "sample_id",
        "position",
        lab.predicted_class(logits).alias("label_id"),
        F.round(lab.predicted_probability(logits), 6).alias("confidence"),
    )


@query("n05_drop_special", f"{SPANS} SELECT {TOKEN_COLUMNS} FROM seen")
def n05(spark: SparkSession, sf: str) -> DataFrame:
    return lab.token_rows(tok.labelled(spark, sf).withColumn("tokens", lab.drop_special(F.col("tokens"))))


@query("n06_decode_spans", f'{SPANS} SELECT doc_id, text, label, start, "end", confidence FROM spans')
def n06(spark: SparkSession, sf: str) -> DataFrame:
    return lab.span_rows(decoded(spark, sf))


@query("n06_decode_token_rows", f'{SPANS} SELECT doc_id, text, label, start, "end", confidence FROM spans')
def n06_rows(spark: SparkSession, sf: str) -> DataFrame:
    return lab.decode_token_rows(n02(spark, sf), ["doc_id"])


@query("n07_span_text", f"{SPANS} SELECT doc_id, start, text FROM spans")
def n07(spark: SparkSession, sf: str) -> DataFrame:
    return n06(spark, sf).select("doc_id", "start", "text")


@query(
    "n08_span_confidence",
    f"""{SPANS} SELECT label, confidence, count(*) AS spans FROM spans GROUP BY label, confidence""",
)
def n08(spark: SparkSession, sf: str) -> DataFrame:
    return n06(spark, sf).groupBy("label", "confidence").agg(F.count(F.lit(1)).alias("spans"))


@query("n09_span_positions", f'{SPANS} SELECT doc_id, label, start, "end" FROM spans')
def n09(spark: SparkSession, sf: str) -> DataFrame:
    return n06(spark, sf).select("doc_id", "label", "start", "end")


@query(
    "n10_demote_tags",
    f"""{SPANS} SELECT doc_id, position,
      CAST(CASE WHEN label_id <> 0 AND round(confidence, 4) < 0.85 THEN 0 ELSE label_id END AS INTEGER) AS tag
    FROM seen""",
)
def n10(spark: SparkSession, sf: str) -> DataFrame:
    return n05(spark, sf).select(
        "doc_id", "position", lab.demoted_id(F.col("label_id"), F.col("confidence")).alias("tag")
    )


@query(
    "n11_confident_spans",
    f'{SPANS} SELECT doc_id, text, label, start, "end", confidence FROM spans WHERE confidence >= 0.85',
)
def n11(spark: SparkSession, sf: str) -> DataFrame:
    return lab.span_rows(decoded(spark, sf).withColumn("spans", lab.confident(F.col("spans"))))


SILVER = f"""{SPANS},
  good AS (SELECT doc_id, count(*) AS n, sum(CAST(round(confidence * 10000) AS BIGINT)) AS s
           FROM spans WHERE confidence >= 0.85 GROUP BY doc_id),
  texts AS (
    SELECT doc_id, string_agg(token, ' ' ORDER BY position) AS tokens,
      string_agg(CASE WHEN label_id <> 0 AND confidence < 0.85 THEN '0' ELSE CAST(label_id AS VARCHAR) END, ','
                 ORDER BY position) AS tags FROM seen GROUP BY doc_id)
  SELECT doc_id, tokens, tags, CAST(coalesce(n, 0) AS INTEGER) AS num_entities,
    coalesce(floor(CAST(2 * s + n AS DOUBLE) / (2 * n)) / 10000, 0.0) AS avg_confidence
  FROM texts LEFT JOIN good USING (doc_id)"""


def _flat_silver(silver: DataFrame) -> DataFrame:
    return silver.withColumns(
        {"tokens": t.joined("tokens", " "), "tags": t.joined(F.col("tags").cast("array<string>"), ",")}
    )


@query("n12_silver_labels", SILVER)
def n12(spark: SparkSession, sf: str) -> DataFrame:
    return _flat_silver(lab.silver_labels(decoded(spark, sf)))


@query(
    "s11_write_silver_labels",
    f"SELECT doc_id, tokens, tags, avg_confidence AS confidence, 'pubmed_weak_label' AS source FROM ({SILVER})",
)
def s11(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "silver")
    sinks.write_silver_labels(lab.silver_labels(decoded(spark, sf)), path)
    schema = "doc_id string, tokens array<string>, tags array<int>, confidence double, source string"
    return _flat_silver(spark.read.schema(schema).json(path))


@query(
    "n13_label_report",
    f"""{SPANS}
    SELECT (SELECT count(*) FROM clean) AS total_abstracts, count(*) AS total_entities,
      count(*) FILTER (confidence >= 0.85) AS high_confidence_entities,
      round(100 * (count(*) FILTER (confidence >= 0.85)) / greatest(count(*), 1), 6) AS filter_rate_pct,
      count(*) FILTER (confidence >= 0.85 AND label = 'Chemical') AS chemical,
      count(*) FILTER (confidence >= 0.85 AND label = 'Disease') AS disease
    FROM spans""",
)
def n13(spark: SparkSession, sf: str) -> DataFrame:
    report = lab.label_report(decoded(spark, sf))
    return report.select(
        "total_abstracts",
        "total_entities",
        "high_confidence_entities",
        F.round("filter_rate_pct", 6).alias("filter_rate_pct"),
        F.col("entity_counts")["Chemical"].alias("chemical"),
        F.col("entity_counts")["Disease"].alias("disease"),
    )


@query(
    "n14_document_summary",
    f"""{SPANS},
    typed AS (SELECT doc_id, label, count(*) AS n FROM spans GROUP BY ALL),
    summed AS (SELECT doc_id, sum(n) AS n,
        string_agg(label || ':' || CAST(n AS VARCHAR), ',' ORDER BY label) AS s FROM typed GROUP BY doc_id)
    SELECT doc_id, CAST(len(tokens) AS INTEGER) AS num_tokens, CAST(coalesce(n, 0) AS INTEGER) AS entities_found,
      coalesce(s, '') AS entity_summary
    FROM pieces LEFT JOIN summed USING (doc_id)""",
)
def n14(spark: SparkSession, sf: str) -> DataFrame:
    pairs = F.transform(
        F.map_entries("entity_summary"), lambda e: F.concat_ws(":", e["key"], e["value"].cast("string"))
    )
    return lab.document_summary(decoded(spark, sf)).withColumn("entity_summary", t.joined(pairs, ","))


BOTH = f"WITH {tok.PIECES}, {tok.sql_spans('a', '_a')}, {tok.sql_spans('b', '_b')}"


@query(
    "n15_compare_models",
    f"""{BOTH},
    joined AS (
      SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, a.doc_id IS NOT NULL AS in_a, b.doc_id IS NOT NULL AS in_b
      FROM spans_a a FULL JOIN spans_b b
        ON a.doc_id = b.doc_id AND a.start = b.start AND a."end" = b."end" AND a.label = b.label)
    SELECT doc_id, CAST(count(*) FILTER (in_a) AS INTEGER) AS entities_a, CAST(count(*) FILTER (in_b) AS INTEGER) AS entities_b,
      CAST(count(*) FILTER (in_a AND in_b) AS INTEGER) AS both, CAST(count(*) FILTER (NOT in_b) AS INTEGER) AS only_a,
      CAST(count(*) FILTER (NOT in_a) AS INTEGER) AS only_b
    FROM pieces LEFT JOIN joined USING (doc_id) GROUP BY doc_id""",
)
def n15(spark: SparkSession, sf: str) -> DataFrame:
    return lab.span_agreement(both_decoded(spark, sf))


@query(
    "n15_compare_documents",
    f"""{BOTH}, {tok.LATENCIES},
    sides AS (
      SELECT p.doc_id, count(a.doc_id) AS n FROM pieces p LEFT JOIN spans_a a USING (doc_id) GROUP BY p.doc_id),
    others AS (
      SELECT p.doc_id, count(b.doc_id) AS n FROM pieces p LEFT JOIN spans_b b USING (doc_id) GROUP BY p.doc_id)
    SELECT doc_id, CAST(s.n AS INTEGER) AS entities_a, CAST(o.n AS INTEGER) AS entities_b,
      latency_a_ms, latency_b_ms
    FROM sides s JOIN others o USING (doc_id) JOIN latencies l ON CAST(s.doc_id AS BIGINT) = l.sample_id""",
)
def n15_documents(spark: SparkSession, sf: str) -> DataFrame:
    counts = lab.span_agreement(both_decoded(spark, sf)).select("doc_id", "entities_a", "entities_b")
    times = tok.latencies(spark, sf).withColumn("doc_id", F.col("sample_id").cast("string")).drop("sample_id")
    return counts.join(times, "doc_id")


@query(
    "p14_annotate_text",
    f"""{SPANS},
    sure AS (SELECT doc_id, text, max(confidence) AS c FROM spans WHERE confidence >= 0.85 GROUP BY ALL),
    best AS (SELECT s.doc_id, s.text, c, min(label) AS label FROM spans s JOIN sure USING (doc_id, text)
             WHERE s.confidence = c GROUP BY ALL),
    tags AS (SELECT doc_id, text, '<span class="entity entity-' || label || '" title="' || label || ': '
               || printf('%.1f', round(c * 100, 1)) || '% confidence">' || text || '</span>' AS tag FROM best),
    choices AS (SELECT doc_id, string_agg(text, '|' ORDER BY length(text) DESC, text) AS choice,
                  map(list(text ORDER BY text), list(tag ORDER BY text)) AS named FROM tags GROUP BY doc_id),
    cut AS (SELECT doc_id, text_clean, choice, named,
              list_zip(string_split_regex(text_clean, choice), regexp_extract_all(text_clean, choice)) AS parts
            FROM clean LEFT JOIN choices USING (doc_id))
    SELECT doc_id, CASE WHEN choice IS NULL THEN text_clean ELSE
      array_to_string(list_transform(parts, lambda p: p[1] || coalesce(map_extract(named, p[2])[1], '')), '') END AS annotated
    FROM cut""",
)
def p14(spark: SparkSession, sf: str) -> DataFrame:
    docs = t.cleaned(spark, sf).select("doc_id", F.col("text_clean").alias("text"))
    return annotate_text(docs, n11(spark, sf)).select("doc_id", "annotated")


def _sentences(spark: SparkSession, sf: str) -> DataFrame:
    """Words of each conversation turn with tags, and word numbers of their pieces (null at both ends)."""
    text = F.regexp_replace(F.regexp_replace("text", r"^\s+|\s+$", ""), r"\s+", " ")
    words = t.table(spark, sf, "conversations").select("conv_id", "turn", F.split(text, " ").alias("words"))
    tags = F.transform("words", lambda w, i: ((F.length(w) * 7 + i) % 5).cast("int"))

    def repeated(word: Column, i: Column) -> Column:
        return F.array_repeat(i, F.floor((F.length(word) + 3) / 4).cast("int"))

    outside = F.array(F.lit(None).cast("int"))
    ids = F.concat(outside, F.flatten(F.transform("words", repeated)), outside)
    return words.select("conv_id", "turn", tags.alias("tags"), ids.alias("word_ids"))


SENTENCES = f"""sentences AS (
  SELECT conv_id, turn, string_split(regexp_replace(regexp_replace(text, '^[{t.SPACE}]+|[{t.SPACE}]+$', '', 'g'),
    '[{t.SPACE}]+', ' ', 'g'), ' ') AS words FROM conversations),
word_rows AS (
  SELECT conv_id, turn, unnest(words) AS word, unnest(range(len(words))) AS i FROM sentences),
piece_rows AS (
  SELECT conv_id, turn, i, CAST((length(word) * 7 + i) % 5 AS INTEGER) AS tag,
    unnest(range((length(word) + 3) // 4)) AS piece FROM word_rows),
aligned AS (
  SELECT conv_id, turn, i, piece,
    CASE WHEN piece = 0 THEN tag WHEN tag IN (1, 3) THEN tag + 1 ELSE tag END AS label FROM piece_rows)"""


@query(
    "n16_align_labels",
    f"""WITH {SENTENCES}
    SELECT conv_id, turn, '-100,' || string_agg(CAST(label AS VARCHAR), ',' ORDER BY i, piece) || ',-100' AS labels
    FROM aligned GROUP BY conv_id, turn""",
)
def n16(spark: SparkSession, sf: str) -> DataFrame:
    labels = lab.align_labels(F.col("tags"), F.col("word_ids"))
    return _sentences(spark, sf).select(
        "conv_id", "turn", t.joined(labels.cast("array<string>"), ",").alias("labels")
    )


@query(
    "n17_pad_sequences",
    f"""WITH {SENTENCES},
    ids AS (SELECT conv_id, turn, [101] || list(CAST(i + 1000 AS INTEGER) ORDER BY i, piece) || [102] AS ids
            FROM aligned GROUP BY conv_id, turn)
    SELECT conv_id, turn,
      array_to_string([coalesce(ids[k], 0) for k in range(1, 129)], ',') AS input_ids,
      array_to_string([CASE WHEN k <= len(ids) THEN 1 ELSE 0 END for k in range(1, 129)], ',') AS attention_mask
    FROM ids""",
)
def n17(spark: SparkSession, sf: str) -> DataFrame:
    first = F.transform("word_ids", lambda w, i: F.coalesce(w + 1000, F.when(i == 0, 101).otherwise(102)))
    ids = _sentences(spark, sf).select("conv_id", "turn", first.alias("ids"))
    return ids.select(
        "conv_id",
        "turn",
        t.joined(lab.pad(F.col("ids")).cast("array<string>"), ",").alias("input_ids"),
        t.joined(lab.attention_mask(F.col("ids")).cast("array<string>"), ",").alias("attention_mask"),
    )


@query(
    "p14_annotate_corpus",
    f"""WITH {tok.PIECES}, {tok.sql_spans()},
    sure AS (SELECT lower(text) AS entry, label, confidence, max(confidence) OVER (PARTITION BY lower(text)) AS top
      FROM spans WHERE confidence >= 0.85 AND length(text) > 0),
    entries AS (SELECT entry, min(label) AS label FROM sure WHERE confidence = top GROUP BY entry),
    joined AS (SELECT '(' || string_agg(regexp_escape(entry), '|' ORDER BY length(entry) DESC, entry) || ')' AS pattern FROM entries),
    found AS (SELECT doc_id, unnest(regexp_extract_all(lower(text_clean), pattern)) AS entry FROM clean, joined)
    SELECT doc_id, count(*) AS matches, count(*) FILTER (label = 'Chemical') AS chemicals,
      CAST(sum(length(entry)) AS BIGINT) AS covered FROM found JOIN entries USING (entry) GROUP BY doc_id""",
)
def p14_corpus(spark: SparkSession, sf: str) -> DataFrame:
    """Every entity text of the corpus is looked for in every document."""
    docs = t.cleaned(spark, sf).select("doc_id", F.col("text_clean").alias("text"))
    found = dictionary_matches(docs, n11(spark, sf)).select("doc_id", F.explode("matches").alias("m"))
    return found.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("matches"),
        F.count_if(F.col("m.label") == "Chemical").alias("chemicals"),
        F.sum(F.col("m.end") - F.col("m.start")).alias("covered"),
    )
