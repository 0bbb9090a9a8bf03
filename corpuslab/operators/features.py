"""Token features: TF-IDF, bigrams and their vector forms."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, HashingTF, NGram, StopWordsRemover, Tokenizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from corpuslab.functions import text as X
from corpuslab.functions.arrays import once, rows_of
from corpuslab.functions.stopwords import STOP_WORDS
from corpuslab.session import via_table

from .skew import lookup_join

BUCKETS = 4096


def build_feature_pipeline(buckets: int = BUCKETS, ngram: int = 2) -> Pipeline:
    """Tokens, stop words, n-grams and two hashed TF-IDF vectors as one estimator."""
    stages = [
        Tokenizer(inputCol="text_clean", outputCol="words"),
        StopWordsRemover(inputCol="words", outputCol="filtered_words", stopWords=STOP_WORDS),
        NGram(n=ngram, inputCol="filtered_words", outputCol="bigrams"),
    ]
    for source, raw, weighted in (
        ("filtered_words", "raw_features", "tfidf_features"),
        ("bigrams", "bigram_raw_features", "bigram_tfidf_features"),
    ):
        stages.append(HashingTF(inputCol=source, outputCol=raw, numFeatures=buckets))
        stages.append(IDF(inputCol=raw, outputCol=weighted))
    return Pipeline(stages=stages)


def extract_features(df: DataFrame, buckets: int = BUCKETS) -> tuple[DataFrame, PipelineModel]:
    """Fit on ``df`` and transform it; the model is that of ``build_feature_pipeline``.

    The words and both hashed vectors are computed once and written; the two
    fits read only their vector.
    """
    tokenizer, remover, ngrams, *weighting = build_feature_pipeline(buckets).getStages()
    hashed = token_columns(df)
    for stage in weighting[::2]:
        hashed = stage.transform(hashed)
    rows = via_table(hashed, "hashed")
    stages = [tokenizer, remover, ngrams]
    out = rows
    for counts, weights in zip(weighting[::2], weighting[1::2], strict=True):
        fitted = weights.fit(rows.select(weights.getInputCol()))
        out = fitted.transform(out)
        stages += [counts, fitted]
    return out, PipelineModel(stages=stages)


def hashed_features(
    df: DataFrame, words: str, raw: str, weighted: str | None = None, buckets: int = BUCKETS
) -> DataFrame:
    """Hashed term frequencies of ``words`` and, if named, their IDF weighting."""
    counted = HashingTF(inputCol=words, outputCol=raw, numFeatures=buckets).transform(df)
    return counted if weighted is None else IDF(inputCol=raw, outputCol=weighted).fit(counted).transform(counted)


def token_columns(df: DataFrame, clean: str = "text_clean") -> DataFrame:
    """words, filtered_words and bigrams as plain expressions, without an estimator.

    Words that cleaning has already split off are taken as they are.
    """
    tokens = df if "words" in df.columns else df.withColumn("words", X.tokenize(F.col(clean)))
    kept = tokens.withColumn("filtered_words", X.drop_stop_words(F.col("words")))
    return kept.withColumn("bigrams", X.bigrams(F.col("filtered_words")))


def vector_entries(df: DataFrame, keep: list[str], vector: str) -> DataFrame:
    """Non-zero entries of a vector column as (keep, index, value) rows. A sparse
    vector yields its entries without being filled up."""
    fields = once(df.select(*keep, F.unwrap_udt(vector).alias("_u")), _entries=_entries(F.col("_u")))
    return rows_of(fields, keep, "_entries").filter(F.col("value") != 0)


def _entries(vector: Column) -> Column:
    def entry(index: Column, value: Column) -> Column:
        return F.struct(index.alias("index"), value.alias("value"))

    sparse = F.zip_with(vector["indices"], vector["values"], entry)
    dense = F.transform(vector["values"], lambda x, i: entry(i, x))
    return F.when(vector["type"] == 0, sparse).otherwise(dense)


def term_counts(df: DataFrame, doc_id: str = "doc_id", words: str = "filtered_words") -> DataFrame:
    """(doc, term, tf) rows, counted inside each document row: nothing is shuffled.

    The words are sorted, a term's count is the distance between the position
    where it starts and the position where the next one does.
    """
    ordered = df.filter(F.size(words) > 0).select(doc_id, F.sort_array(words).alias("_sorted"))
    starts = F.filter(
        F.sequence(F.lit(0), F.size("_sorted") - 1),
        lambda i: (i == 0) | (F.get("_sorted", i) != F.get("_sorted", i - 1)),
    )
    marked = ordered.withColumn("_starts", starts)
    ends = F.concat(F.slice("_starts", F.lit(2), F.size("_starts")), F.array(F.size("_sorted")))
    terms = F.zip_with(
        F.col("_starts"),
        ends,
        lambda s, e: F.struct(F.get("_sorted", s).alias("term"), (e - s).cast("bigint").alias("tf")),
    )
    return rows_of(marked, [doc_id], terms)


def tfidf(df: DataFrame, doc_id: str = "doc_id", words: str = "filtered_words") -> DataFrame:
    """Exact TF-IDF per (doc, term): tf * ln((documents + 1) / (documents with the term + 1)).

    The counts are written once; a document has one row of them per term, so the
    frequencies are counts of these rows. A term that is in most documents is
    weighted without moving its rows.
    """
    counts = via_table(term_counts(df, doc_id, words), "term-counts")
    documents = df.agg(F.count(F.lit(1)).alias("m"))
    frequency = via_table(counts.groupBy("term").agg(F.count(F.lit(1)).alias("df")), "frequency")
    joined = lookup_join(counts, frequency, "term", "df")
    weight = F.log((documents.scalar() + 1) / (F.col("df") + 1))
    return joined.select(doc_id, "term", "tf", "df", (F.col("tf") * weight).alias("tfidf"))


def top_terms(weighted: DataFrame, k: int, doc_id: str = "doc_id") -> DataFrame:
    """The ``k`` terms of highest weight per document, ties by term."""
    best = Window.partitionBy(doc_id).orderBy(F.desc("tfidf"), "term")
    return weighted.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
