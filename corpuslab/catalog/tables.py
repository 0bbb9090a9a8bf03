"""The given tables in the shapes the operators take, and the same as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpuslab.functions.stopwords import STOP_WORDS
from corpuslab.operators.cleaning import clean_text
from corpuslab.operators.features import token_columns
from corpuslab.sources.corpus import read_corpus, spread


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A given table. An input with fewer partitions than the session has
    cores is spread over them; a large one is left as it is."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spread(read_corpus(spark, f"{sf}/{name}.parquet"), spark.sparkContext.defaultParallelism)


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), "text", "source")


def corpus(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    labels = read_corpus(spark, f"{sf}/labels.parquet").select("doc_id", "quality")
    return docs.join(labels, "doc_id", "left").select(
        F.col("doc_id").cast("string").alias("doc_id"),
        "text",
        F.coalesce("quality", F.lit(-1)).alias("rating"),
        "source",
    )


def cleaned(spark: SparkSession, sf: str, rated: bool = False) -> DataFrame:
    return clean_text(corpus(spark, sf) if rated else documents(spark, sf))


def features(spark: SparkSession, sf: str, rated: bool = False) -> DataFrame:
    source = corpus(spark, sf) if rated else documents(spark, sf)
    return token_columns(clean_text(source, keep_words=True))


SPACE = r"\t\n\x0B\f\r "


def sql_half_up(value: str, places: int) -> str:
    """Rounded half up as a decimal, like ``functions.numbers.half_up``."""
    return f"CAST(round(CAST({value} AS DECIMAL(28, 10)), {places}) AS DOUBLE)"


def quoted(words: list[str]) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


CORPUS = """
corpus AS (
  SELECT CAST(d.doc_id AS VARCHAR) AS doc_id, d.text,
         CAST(coalesce(l.quality, -1) AS INTEGER) AS rating, d.source
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""

SQL_LOWER = "lower(text)"
SQL_STRIP = "regexp_replace(lower(text), '<[^>]+>', ' ', 'g')"
SQL_KEEP = f"regexp_replace({SQL_STRIP}, '[^a-z0-9{SPACE}-]', ' ', 'g')"
SQL_CLEAN = f"trim(regexp_replace({SQL_KEEP}, '[{SPACE}]+', ' ', 'g'))"

COUNTED = f"""{CORPUS},
counted AS (
  SELECT *, CAST(length(text_clean) AS INTEGER) AS text_length,
         CAST(len(string_split(text_clean, ' ')) AS INTEGER) AS word_count
  FROM (SELECT *, {SQL_CLEAN} AS text_clean FROM corpus
        WHERE text IS NOT NULL AND length(text) > 10))"""

CLEAN = f"""{COUNTED},
clean AS (SELECT * FROM counted WHERE word_count BETWEEN 5 AND 2000)"""

TOKENS = f"""{CLEAN},
tokenized AS (
  SELECT *, string_split(text_clean, ' ') AS words FROM clean),
filtered AS (
  SELECT *, list_filter(words, lambda w: w NOT IN ({quoted(STOP_WORDS)})) AS filtered_words FROM tokenized)"""

WORDS = f"""{TOKENS},
word_rows AS (SELECT doc_id, rating, unnest(filtered_words) AS word FROM filtered)"""


def joined(values: str | Column, separator: str = "|") -> Column:
    """An array as one string, so that results compare as plain columns."""
    return F.array_join(values, separator)
