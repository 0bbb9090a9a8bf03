"""Rows that every operator must take."""

from pyspark.sql import Row, types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
#: Columns whose names the operators use themselves.
CLASHING = ["ids", "n_tokens", "start", "key", "hash", "value", "position", "part"]


def docs_of(spark, rows, clashing=False):
    """Documents from (doc_id, text) pairs, on two partitions."""
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA).repartition(2)
    if clashing:
        from pyspark.sql import functions as F

        df = df.withColumns({name: F.lit("x") for name in CLASHING})
    return df


ODD = [
    (5, None),
    (3, ""),
    (4, "   "),
    (7, "a  b\n\n c\t d  \n"),
    (8, "don't I'll we've  12 345 naïve 你好世界 😀  x   \x1c y <|endoftext|> "),
    (9, " lead and trail "),
    (11, "same same"),
    (11, "same same"),
    (12, "same same"),
    (13, "x" * 5000 + " " + "ab" * 3000),
    (-2, "minus"),
    (None, "no id"),
]


def rows(df):
    return [r.asDict() if isinstance(r, Row) else r for r in df.collect()]
