"""Queries over documents and pages: sources, text, features, statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpuslab.functions import text as X
from corpuslab.operators import cleaning, corpusstats, features as feats
from corpuslab.session import scratch_path, via_table
from corpuslab.sources import corpus as src, files, sinks

from . import tables as t
from .registry import registry

QUERIES, ORACLES, query = registry()

# ---- sources and sinks


@query("s01_read_corpus", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def s01(spark: SparkSession, sf: str) -> DataFrame:
    return src.read_corpus(spark, f"{sf}/documents.parquet")


@query(
    "s02_normalize_schema",
    f"""WITH {t.CORPUS}
    SELECT 'plain' AS layout, doc_id, text, rating, source FROM corpus
    UNION ALL SELECT 'review', doc_id, text, rating, source FROM corpus
    UNION ALL SELECT 'content', sha256(text), text, rating, source FROM corpus""",
)
def s02(spark: SparkSession, sf: str) -> DataFrame:
    plain = t.corpus(spark, sf)
    review = plain.toDF("review_id", "review_body", "star_rating", "product_title")
    content = plain.drop("doc_id").toDF("content", "label", "title")
    shaped = [
        src.normalize_schema(df).select(F.lit(name).alias("layout"), "doc_id", "text", "rating", "source")
        for name, df in (("plain", plain), ("review", review), ("content", content))
    ]
    return shaped[0].unionByName(shaped[1]).unionByName(shaped[2])


@query("s03_read_abstracts", "SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 500")
def s03(spark: SparkSession, sf: str) -> DataFrame:
    return src.read_abstracts(spark, f"{sf}/documents.parquet", 500, order="doc_id").select("doc_id", "text")


@query(
    "s04_read_text_files",
    f"""SELECT CAST(doc_id AS VARCHAR) AS doc_id,
      CASE WHEN stripped <> '' THEN stripped END AS text,
      CASE WHEN stripped = '' THEN 'File is empty' END AS error
    FROM (SELECT doc_id, regexp_replace(text, '^[{t.SPACE}]+|[{t.SPACE}]+$', '', 'g') AS stripped FROM documents)""",
)
def s04(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "text-files")
    sinks.write_text_files(t.documents(spark, sf), path, "doc_id", "text")
    return files.read_text_files(spark, path).select(
        F.regexp_extract("path", "doc_id=([^/]+)", 1).alias("doc_id"), "text", "error"
    )


@query(
    "s12_expand_corpus",
    f"""WITH {t.CORPUS}
    SELECT doc_id || '_v' || lpad(CAST(i AS VARCHAR), 3, '0') AS doc_id,
      CASE i % 3 WHEN 0 THEN text || ' Follow-up appointment scheduled.'
                 WHEN 1 THEN 'Additional notes: ' || text ELSE text END AS text,
      rating, source
    FROM corpus, range(4) r(i)""",
)
def s12(spark: SparkSession, sf: str) -> DataFrame:
    return src.expand_corpus(t.corpus(spark, sf), 4)


@query("s13_spread", "SELECT 100 AS partitions, count(*) AS records FROM documents")
def s13(spark: SparkSession, sf: str) -> DataFrame:
    spread = src.spread(src.read_corpus(spark, f"{sf}/documents.parquet"), 100)
    return spread.agg(F.lit(spread.rdd.getNumPartitions()).alias("partitions"), F.count(F.lit(1)).alias("records"))


VALIDATION = f"""WITH {t.TOKENS},
  rules AS (
    SELECT count(*) AS checked,
      0 AS schema,
      count(*) FILTER (doc_id IS NULL) AS doc_id_present,
      count(*) FILTER (length(text_clean) = 0) AS text_present,
      count(*) FILTER (word_count NOT BETWEEN 5 AND 2000) AS word_count_in_range,
      count(*) FILTER (len(filtered_words) = 0) AS filtered_words_not_empty,
      count(*) - count(DISTINCT doc_id) AS doc_id_unique
    FROM filtered)
  SELECT rule, checked, CAST(violations AS BIGINT) AS violations, violations = 0 AS passed
  FROM (UNPIVOT rules ON schema, doc_id_present, text_present, word_count_in_range, filtered_words_not_empty,
        doc_id_unique INTO NAME rule VALUE violations)"""


@query("s14_validate_output", VALIDATION)
def s14(spark: SparkSession, sf: str) -> DataFrame:
    df = t.features(spark, sf, rated=True)
    required = ["doc_id", "text_clean", "rating", "source", "word_count", "filtered_words"]
    return sinks.validate_output(df, required, sinks.feature_rules(df))


@query(
    "s09_write_features",
    f"""WITH {t.TOKENS}
    SELECT doc_id, text_clean, rating, source, word_count,
           CAST(len(filtered_words) AS INTEGER) AS n_words FROM filtered""",
)
def s09(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "features")
    vectors, _ = feats.extract_features(cleaning.clean_text(t.corpus(spark, sf), keep_words=True))
    sinks.write_features(vectors, path)
    return spark.read.parquet(path).select(
        "doc_id", "text_clean", "rating", "source", "word_count", F.size("filtered_words").alias("n_words")
    )


# ---- text


@query("p01_sample_docs")
def p01(spark: SparkSession, sf: str) -> DataFrame:
    docs = t.documents(spark, sf)
    drawn = src.sample_docs(docs, 0.1).select(F.lit("bernoulli").alias("method"), "doc_id")
    return drawn.unionByName(src.sample_docs(docs, 0.1, by="doc_id").select(F.lit("hashed").alias("method"), "doc_id"))


@query(
    "p01_sample_hashed",
    f"SELECT CAST(doc_id AS VARCHAR) AS doc_id FROM documents "
    f"WHERE substr(sha256('42:' || CAST(doc_id AS VARCHAR)), 1, 8) < '{int(0.1 * 2**32):08x}'",
)
def p01_hashed(spark: SparkSession, sf: str) -> DataFrame:
    return src.sample_docs(t.documents(spark, sf), 0.1, by="doc_id").select("doc_id")


@query("p02_filter_text", "SELECT doc_id, text FROM documents WHERE text IS NOT NULL AND length(text) > 10")
def p02(spark: SparkSession, sf: str) -> DataFrame:
    return t.table(spark, sf, "documents").filter(X.has_text(F.col("text"))).select("doc_id", "text")


@query("p03_lowercase", "SELECT doc_id, lower(text) AS text FROM documents")
def p03(spark: SparkSession, sf: str) -> DataFrame:
    return t.table(spark, sf, "documents").select("doc_id", F.lower("text").alias("text"))


@query("p04_strip_markup", "SELECT page_id, regexp_replace(html, '<[^>]+>', ' ', 'g') AS text FROM pages")
def p04(spark: SparkSession, sf: str) -> DataFrame:
    return t.table(spark, sf, "pages").select("page_id", X.strip_markup(F.col("html")).alias("text"))


@query(
    "p05_keep_allowed",
    f"SELECT doc_id, regexp_replace(lower(text), '[^a-z0-9{t.SPACE}-]', ' ', 'g') AS text FROM documents",
)
def p05(spark: SparkSession, sf: str) -> DataFrame:
    return t.table(spark, sf, "documents").select("doc_id", X.keep_allowed(F.lower("text")).alias("text"))


@query(
    "p06_collapse_spaces",
    f"SELECT doc_id, trim(regexp_replace(text, '[{t.SPACE}]+', ' ', 'g')) AS text FROM documents",
)
def p06(spark: SparkSession, sf: str) -> DataFrame:
    return t.table(spark, sf, "documents").select("doc_id", X.collapse_spaces(F.col("text")).alias("text"))


@query("p07_text_counts", f"WITH {t.COUNTED} SELECT doc_id, text_length, word_count FROM counted")
def p07(spark: SparkSession, sf: str) -> DataFrame:
    clean = F.array_join(X.clean_words(F.col("text")), " ")
    docs = t.documents(spark, sf).filter(X.has_text(F.col("text"))).select("doc_id", clean.alias("c"))
    return docs.select("doc_id", F.length("c").alias("text_length"), X.word_count(F.col("c")).alias("word_count"))


@query("p08_word_range", f"WITH {t.COUNTED} SELECT doc_id, word_count FROM counted WHERE word_count BETWEEN 5 AND 2000")
def p08(spark: SparkSession, sf: str) -> DataFrame:
    return p07(spark, sf).filter(X.words_in_range(F.col("word_count"))).select("doc_id", "word_count")


@query("p09_clean_text", f"WITH {t.CLEAN} SELECT doc_id, text_clean, text_length, word_count, rating, source FROM clean")
def p09(spark: SparkSession, sf: str) -> DataFrame:
    return t.cleaned(spark, sf, rated=True).drop("text")


MARKER, URL_ID, PARAGRAPH = "<article>", r"page=(\d+)", "(?s)<p[^>]*>(.*?)</p>"

RECORDS = """records AS (
  SELECT page_id, url, CAST(i AS INTEGER) AS position, parts[i + 1] AS record
  FROM (SELECT page_id, url, parts, unnest(range(len(parts))) AS i
        FROM (SELECT page_id, url, string_split(html, '<article>') AS parts FROM pages)) WHERE i > 0)"""


@query("p10_split_records", f"WITH {RECORDS} SELECT page_id, position, record FROM records")
def p10(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.split_records(t.table(spark, sf, "pages").select("page_id", "html"), "html", MARKER)


@query(
    "p11_extract_id",
    r"""SELECT page_id, 'pmid_' || coalesce(nullif(regexp_extract(url, 'page=(\d+)', 1), ''), 'unknown') AS pmid
    FROM pages""",
)
def p11(spark: SparkSession, sf: str) -> DataFrame:
    return t.table(spark, sf, "pages").select("page_id", cleaning.extract_id(F.col("url"), URL_ID).alias("pmid"))


PARTS = f"""{RECORDS},
parts AS (
  SELECT page_id, regexp_replace(regexp_replace(
      array_to_string(regexp_extract_all(record, '(?s)<p[^>]*>(.*?)</p>', 1), ' '), '<[^>]+>', '', 'g'),
      '^[{t.SPACE}]+|[{t.SPACE}]+$', '', 'g') AS text
  FROM records)"""


@query("p12_extract_parts", f"WITH {PARTS} SELECT page_id, text FROM parts WHERE length(text) > 50")
def p12(spark: SparkSession, sf: str) -> DataFrame:
    records = p10(spark, sf)
    text = cleaning.extract_parts(F.col("record"), PARAGRAPH)
    return records.select("page_id", text.alias("text")).filter(F.length("text") > 50)


@query(
    "p13_union_ids",
    """SELECT doc_id FROM documents WHERE contains(lower(text), 'the ') UNION
    SELECT doc_id FROM documents WHERE contains(lower(text), 'le ') UNION
    SELECT doc_id FROM documents WHERE lang = 'de'""",
)
def p13(spark: SparkSession, sf: str) -> DataFrame:
    docs = t.table(spark, sf, "documents")
    searches = [F.lower("text").contains("the "), F.lower("text").contains("le "), F.col("lang") == "de"]
    return src.union_ids([docs.filter(s) for s in searches])


@query(
    "p15_request_id",
    """SELECT event_id, CASE WHEN event_type = 'view' THEN 'client-' || CAST(user_id AS VARCHAR)
      ELSE left(sha256(CAST(event_id AS VARCHAR)), 8) END AS request_id FROM events""",
)
def p15(spark: SparkSession, sf: str) -> DataFrame:
    given = F.when(F.col("event_type") == "view", F.concat(F.lit("client-"), F.col("user_id").cast("string")))
    return t.table(spark, sf, "events").select(
        "event_id", cleaning.request_id(given, F.col("event_id")).alias("request_id")
    )


# ---- features


@query(
    "x01_tokenize",
    f"WITH {t.TOKENS} SELECT doc_id, array_to_string(words, '|') AS words FROM filtered",
)
def x01(spark: SparkSession, sf: str) -> DataFrame:
    words = X.tokenize(F.col("text_clean"))
    return t.cleaned(spark, sf).select("doc_id", t.joined(words).alias("words"))


@query(
    "x02_drop_stop_words",
    f"WITH {t.TOKENS} SELECT doc_id, coalesce(array_to_string(filtered_words, '|'), '') AS words FROM filtered",
)
def x02(spark: SparkSession, sf: str) -> DataFrame:
    return t.features(spark, sf).select("doc_id", t.joined("filtered_words").alias("words"))


@query(
    "x03_bigrams",
    f"""WITH {t.TOKENS}
    SELECT doc_id, coalesce(array_to_string(
      [filtered_words[i] || ' ' || filtered_words[i + 1] for i in range(1, len(filtered_words))], '|'), '') AS bigrams
    FROM filtered""",
)
def x03(spark: SparkSession, sf: str) -> DataFrame:
    return t.features(spark, sf).select("doc_id", t.joined("bigrams").alias("bigrams"))


def _entries(spark: SparkSession, sf: str, words: str, weighted: bool, tokens: DataFrame | None = None) -> DataFrame:
    """Entries of the hashed vectors; ``tokens`` are the words if already written."""
    df = t.features(spark, sf).select("doc_id", words) if tokens is None else tokens
    if weighted and tokens is None:
        df = via_table(df, "tokens")
    vectors = feats.hashed_features(df, words, "raw", "weighted" if weighted else None)
    return feats.vector_entries(vectors, ["doc_id"], "weighted" if weighted else "raw")


@query("x04_hashed_tf")
def x04(spark: SparkSession, sf: str) -> DataFrame:
    return _entries(spark, sf, "filtered_words", False)


def _totals(spark: SparkSession, sf: str, words: str) -> DataFrame:
    entries = _entries(spark, sf, words, False)
    return entries.groupBy("doc_id").agg(F.sum("value").cast("bigint").alias("weight"))


@query(
    "x04_hashed_totals",
    f"WITH {t.TOKENS} SELECT doc_id, CAST(len(filtered_words) AS BIGINT) AS weight FROM filtered WHERE len(filtered_words) > 0",
)
def x04_totals(spark: SparkSession, sf: str) -> DataFrame:
    return _totals(spark, sf, "filtered_words")


@query(
    "x06_bigram_totals",
    f"WITH {t.TOKENS} SELECT doc_id, CAST(len(filtered_words) - 1 AS BIGINT) AS weight FROM filtered WHERE len(filtered_words) > 1",
)
def x06_totals(spark: SparkSession, sf: str) -> DataFrame:
    return _totals(spark, sf, "bigrams")


@query("x05_idf")
def x05(spark: SparkSession, sf: str) -> DataFrame:
    return _entries(spark, sf, "filtered_words", True)


@query("x06_bigram_tf")
def x06(spark: SparkSession, sf: str) -> DataFrame:
    return _entries(spark, sf, "bigrams", False)


@query("x07_bigram_idf")
def x07(spark: SparkSession, sf: str) -> DataFrame:
    return _entries(spark, sf, "bigrams", True)


def _off(spark: SparkSession, sf: str, words: str) -> DataFrame:
    """Per document, entries whose weight is not tf * ln((m + 1) / (df + 1)),
    with the frequencies counted again from the plain entries. The texts are
    cleaned once, for both kinds of entries and the number of documents."""
    tokens = via_table(t.features(spark, sf).select("doc_id", words), "tokens")
    counts = via_table(_entries(spark, sf, words, False, tokens), "counts")
    weights = _entries(spark, sf, words, True, tokens).withColumnRenamed("value", "weight")
    m = counts.select(F.count_distinct("doc_id")).scalar()
    df = counts.groupBy("index").agg(F.count(F.lit(1)).alias("df"))
    both = counts.join(df, "index").join(weights, ["doc_id", "index"], "left")
    all_docs = tokens.agg(F.count(F.lit(1))).scalar()
    want = F.col("value") * F.log((F.greatest(all_docs, m) + 1) / (F.col("df") + 1))
    differs = F.abs(F.coalesce("weight", F.lit(0.0)) - want) > 1e-9
    return both.groupBy("doc_id").agg(F.count(F.lit(1)).alias("entries"), F.count_if(differs).alias("off")).select("doc_id", "off")


@query(
    "x05_idf_recomputed",
    f"WITH {t.TOKENS} SELECT doc_id, CAST(0 AS BIGINT) AS off FROM filtered WHERE len(filtered_words) > 0",
)
def x05_off(spark: SparkSession, sf: str) -> DataFrame:
    return _off(spark, sf, "filtered_words")


@query(
    "x07_idf_recomputed",
    f"WITH {t.TOKENS} SELECT doc_id, CAST(0 AS BIGINT) AS off FROM filtered WHERE len(filtered_words) > 1",
)
def x07_off(spark: SparkSession, sf: str) -> DataFrame:
    return _off(spark, sf, "bigrams")


@query("x08_extract_features")
def x08(spark: SparkSession, sf: str) -> DataFrame:
    vectors, _ = feats.extract_features(cleaning.clean_text(t.corpus(spark, sf), keep_words=True))
    kinds = {"unigram": "tfidf_features", "bigram": "bigram_tfidf_features"}
    named = F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(c).alias("vector")) for kind, c in kinds.items()])
    both = vectors.select("doc_id", F.inline_outer(named))
    return feats.vector_entries(both, ["doc_id", "kind"], "vector").groupBy("kind", "doc_id").agg(
        F.count(F.lit(1)).alias("entries"), F.round(F.sum("value"), 6).alias("weight")
    )


TFIDF = f"""{t.WORDS},
tf AS (SELECT doc_id, word AS term, count(*) AS tf FROM word_rows GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
weighted AS (
  SELECT doc_id, term, tf, df, tf * ln(((SELECT count(*) FROM filtered) + 1) / (df + 1)) AS tfidf
  FROM tf JOIN df USING (term))"""


@query("x09_tfidf", f"WITH {TFIDF} SELECT doc_id, term, tf, df, round(tfidf, 6) AS tfidf FROM weighted")
def x09(spark: SparkSession, sf: str) -> DataFrame:
    tokens = via_table(t.features(spark, sf).select("doc_id", "filtered_words"), "tokens")
    return feats.tfidf(tokens).withColumn("tfidf", F.round("tfidf", 6))


@query(
    "x09_top_terms",
    f"""WITH {TFIDF}
    SELECT doc_id, term, CAST(rank AS INTEGER) AS rank, tfidf FROM (
      SELECT doc_id, term, tfidf, row_number() OVER (PARTITION BY doc_id ORDER BY tfidf DESC, term) AS rank
      FROM (SELECT doc_id, term, round(tfidf, 6) AS tfidf FROM weighted)) WHERE rank <= 5""",
)
def x09_top(spark: SparkSession, sf: str) -> DataFrame:
    return feats.top_terms(x09(spark, sf), 5).select("doc_id", "term", "rank", "tfidf")


@query(
    "x10_vector_entries",
    "SELECT vec_id, CAST(i AS INTEGER) AS index, CAST(embedding[i + 1] AS DOUBLE) AS value FROM "
    "(SELECT vec_id, embedding, unnest(range(len(embedding))) AS i FROM embeddings) WHERE embedding[i + 1] <> 0",
)
def x10(spark: SparkSession, sf: str) -> DataFrame:
    from pyspark.ml.functions import array_to_vector

    df = t.table(spark, sf, "embeddings").select("vec_id", array_to_vector("embedding").alias("v"))
    return feats.vector_entries(df, ["vec_id"], "v")


# ---- statistics


@query("a01_record_count", "SELECT count(*) AS records FROM documents WHERE length(text) > 10")
def a01(spark: SparkSession, sf: str) -> DataFrame:
    return corpusstats.record_count(t.documents(spark, sf).filter(X.has_text(F.col("text"))))


@query(
    "a02_cleaning_stats",
    f"WITH {t.CLEAN} SELECT count(*) AS total, round(avg(word_count), 6) AS avg_words, max(word_count) AS max_words FROM clean",
)
def a02(spark: SparkSession, sf: str) -> DataFrame:
    return corpusstats.cleaning_stats(t.cleaned(spark, sf)).withColumn("avg_words", F.round("avg_words", 6))


@query("a03_word_frequencies", f"WITH {t.WORDS} SELECT word, count(*) AS count FROM word_rows GROUP BY word")
def a03(spark: SparkSession, sf: str) -> DataFrame:
    return corpusstats.word_frequencies(t.features(spark, sf))


@query(
    "a04_top_words",
    f"WITH {t.WORDS} SELECT word, count(*) AS count FROM word_rows GROUP BY word ORDER BY count DESC, word LIMIT 50",
)
def a04(spark: SparkSession, sf: str) -> DataFrame:
    return corpusstats.top_words(t.features(spark, sf))


LENGTHS = """count(*) AS total_docs, round(avg(word_count), 6) AS avg_doc_length,
  round(stddev_samp(word_count), 6) AS std_doc_length, quantile_disc(word_count, 0.5) AS median_doc_length,
  quantile_disc(word_count, 0.95) AS p95_doc_length, CAST(sum(word_count) AS BIGINT) AS total_words"""


@query("a05_length_stats", f"WITH {t.CLEAN} SELECT {LENGTHS} FROM clean")
def a05(spark: SparkSession, sf: str) -> DataFrame:
    stats = corpusstats.length_stats(t.cleaned(spark, sf))
    return stats.withColumns({c: F.round(c, 6) for c in ("avg_doc_length", "std_doc_length")})


@query("a06_rating_distribution", f"WITH {t.CLEAN} SELECT rating, count(*) AS count FROM clean GROUP BY rating")
def a06(spark: SparkSession, sf: str) -> DataFrame:
    return corpusstats.rating_distribution(t.cleaned(spark, sf, rated=True))


STATS = f"""WITH {t.WORDS},
  lengths AS (SELECT {LENGTHS} FROM clean),
  best AS (SELECT word, count(*) AS n FROM word_rows GROUP BY word ORDER BY n DESC, word LIMIT 20),
  ratings AS (SELECT CAST(rating AS VARCHAR) AS rating, count(*) AS n FROM clean GROUP BY rating)
  SELECT total_docs AS total_documents, total_words, round(avg_doc_length, 1) AS avg_document_length,
    round(std_doc_length, 1) AS std_document_length, median_doc_length AS median_document_length,
    p95_doc_length AS p95_document_length,
    (SELECT string_agg(word || ':' || CAST(n AS VARCHAR), ',' ORDER BY n DESC, word) FROM best) AS top_words,
    (SELECT string_agg(rating || ':' || CAST(n AS VARCHAR), ',' ORDER BY rating) FROM ratings) AS ratings
  FROM lengths"""


def _flat_stats(stats: DataFrame) -> DataFrame:
    def pairs(values, key, count):
        return F.array_join(F.transform(values, lambda s: F.concat_ws(":", s[key], s[count].cast("string"))), ",")

    ratings = F.map_entries("rating_distribution")
    return stats.select(
        *[c for c in stats.columns if c not in ("top_20_words", "rating_distribution")],
        pairs(F.col("top_20_words"), "word", "count").alias("top_words"),
        pairs(F.array_sort(ratings), "key", "value").alias("ratings"),
    )


@query("a07_corpus_statistics", STATS)
def a07(spark: SparkSession, sf: str) -> DataFrame:
    needed = t.features(spark, sf, rated=True).select("filtered_words", "word_count", "rating")
    return _flat_stats(corpusstats.corpus_statistics(via_table(needed, "statistics-input")))


@query("s10_write_stats", STATS)
def s10(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "stats")
    needed = t.features(spark, sf, rated=True).select("filtered_words", "word_count", "rating")
    stats = corpusstats.corpus_statistics(via_table(needed, "statistics-input"))
    sinks.write_stats(stats, path)
    return _flat_stats(spark.read.schema(stats.schema).json(path))


@query("a08_run_metrics")
def a08(spark: SparkSession, sf: str) -> DataFrame:
    return corpusstats.run_metrics(t.cleaned(spark, sf))


@query(
    "a08_run_counts",
    f"WITH {t.CLEAN} SELECT count(*) AS input_records, 'batch' AS mode, TRUE AS timed, TRUE AS consistent FROM clean",
)
def a08_counts(spark: SparkSession, sf: str) -> DataFrame:
    seconds, rate = F.col("total_runtime_seconds"), F.col("throughput_docs_per_second")
    return a08(spark, sf).select(
        "input_records",
        "mode",
        (seconds > 0).alias("timed"),
        (F.abs(rate * seconds - F.col("input_records")) < 0.001).alias("consistent"),
    )


@query(
    "a09_text_lengths",
    f"""WITH {PARTS} SELECT count(*) AS total_abstracts, round(avg(length(text)), 6) AS avg_length
    FROM parts WHERE length(text) > 50""",
)
def a09(spark: SparkSession, sf: str) -> DataFrame:
    return corpusstats.text_lengths(p12(spark, sf)).withColumn("avg_length", F.round("avg_length", 6))


ARMS = "SELECT CASE event_id % 2 WHEN 0 THEN 'A' ELSE 'B' END AS arm, value FROM events"


@query(
    "a10_histogram",
    f"""WITH arms AS ({ARMS}),
    ends AS (SELECT arm, min(value) AS lo, (max(value) - min(value)) / 30 AS w FROM arms GROUP BY arm)
    SELECT e.arm, CAST(r.bin AS INTEGER) AS bin, round(lo + w * r.bin, 6) AS low, count(p.arm) AS n
    FROM ends e CROSS JOIN range(30) r(bin)
    LEFT JOIN (SELECT arm, least(floor((value - lo) / w), 29) AS bin FROM arms JOIN ends USING (arm)) p
      ON p.arm = e.arm AND p.bin = r.bin
    GROUP BY e.arm, r.bin, lo, w""",
)
def a10(spark: SparkSession, sf: str) -> DataFrame:
    arm = F.when(F.pmod("event_id", F.lit(2)) == 0, "A").otherwise("B")
    events = t.table(spark, sf, "events").select(arm.alias("arm"), "value")
    return corpusstats.histogram(events, ["arm"], "value", 30).withColumn("low", F.round("low", 6))


@query(
    "a11_rolling_mean",
    """WITH sized AS (SELECT greatest(count(*) // 20, 5) AS w FROM events),
    sums AS (SELECT event_id, value, row_number() OVER (ORDER BY event_id) AS i,
      sum(CAST(value AS DECIMAL(28, 6))) OVER (ORDER BY event_id) AS s FROM events)
    SELECT a.event_id, a.value,
      CASE WHEN a.i >= w THEN round(CAST(a.s - coalesce(b.s, 0) AS DOUBLE) / w, 6) END AS value_rolling
    FROM sums a CROSS JOIN sized LEFT JOIN sums b ON b.i = a.i - w""",
)
def a11(spark: SparkSession, sf: str) -> DataFrame:
    events = t.table(spark, sf, "events").select("event_id", "value")
    rolled = corpusstats.rolling_mean(events, "event_id", ["value"])
    return rolled.withColumn("value_rolling", F.round("value_rolling", 6))
