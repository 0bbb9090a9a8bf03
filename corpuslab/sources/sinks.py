"""Written results and their validation."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from corpuslab.session import drop_table, store_of

# The columns of the feature table, and the name of the silver source.
FEATURE_COLUMNS = [
    "doc_id",
    "text_clean",
    "rating",
    "source",
    "word_count",
    "filtered_words",
    "tfidf_features",
    "bigram_tfidf_features",
]
SILVER_SOURCE = "pubmed_weak_label"


def write_features(df: DataFrame, path: str) -> None:
    """The eight feature columns as Parquet, one folder per rating. No shuffle:
    a rating that holds most rows is written by all tasks that have some.

    Ratings that ``df`` has are replaced when all of it is written, others stay;
    a job that fails on the way leaves the table as it was.
    """
    rows = df.select(*FEATURE_COLUMNS).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    rows.partitionBy("rating").parquet(path)


#: Files of one folder: listings share folders.
FOLDER_FILES = 1_000


def write_text_files(df: DataFrame, path: str, key: str, value: str) -> None:
    """One text file per ``key`` and task, named ``key``=…, whose lines are the
    values (null: an empty line). Tasks write the files where they stay, a
    thousand to a folder; a task that runs again writes the same ones."""
    name = F.coalesce(F.col(key).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))
    rows = df.select(name.alias("name"), F.coalesce(value, F.lit("")).alias("value"), key).sortWithinPartitions(key)

    def write(batches):
        task = TaskContext.get().partitionId()
        store, root = store_of(path)
        files, last, out = 0, None, None
        try:
            for batch in batches:
                for name, text in zip(batch.column("name").to_pylist(), batch.column("value").to_pylist(), strict=True):
                    if name != last:
                        if out is not None:
                            out.close()
                        folder = f"{root.rstrip('/')}/part-{task:05d}-{files // FOLDER_FILES:05d}"
                        if files % FOLDER_FILES == 0:
                            store.create_dir(folder)
                        out = store.open_output_stream(f"{folder}/{key}={quote(name, safe=' ')}", compression=None)
                        files, last = files + 1, name
                    out.write(text.encode() + b"\n")
        finally:
            if out is not None:
                out.close()
        yield pa.RecordBatch.from_arrays([pa.array([files], pa.int64())], names=["files"])

    try:
        store, root = store_of(path)
    except (ValueError, pa.ArrowException):
        # A file system that only Spark's writers know.
        df.select(key, value).write.partitionBy(key).text(path)
        return
    store.create_dir(root)
    rows.select("name", "value").mapInArrow(write, "files bigint").agg(F.sum("files")).collect()


def replace_folder(path: str, write: Callable[[str], None]) -> None:
    """``write`` fills a folder beside ``path`` that takes its place when all is
    written: a job that fails on the way leaves the former content readable. If
    the exchange itself is cut off, the former content is found in
    ``path``-former, and the next run puts it back or finishes."""
    store, root = store_of(path)
    fresh, former = f"{path.rstrip('/')}-new-{uuid.uuid4().hex}", f"{root.rstrip('/')}-former"
    if _exists(store, former) and not _exists(store, root):
        store.move(former, root)
    try:
        write(fresh)
        if _exists(store, former):
            store.delete_dir(former)
        if _exists(store, root):
            store.move(root, former)
        store.move(store_of(fresh)[1], root)
    except BaseException:
        drop_table(fresh)
        raise
    if _exists(store, former):
        store.delete_dir(former)


def _exists(store: fs.FileSystem, path: str) -> bool:
    return store.get_file_info(path).type != fs.FileType.NotFound


def write_stats(df: DataFrame, path: str) -> None:
    rows = df.select(F.to_json(F.struct("*")).alias("value"))
    replace_folder(path, lambda fresh: rows.write.text(fresh))


def write_silver_labels(df: DataFrame, path: str, source: str = SILVER_SOURCE) -> None:
    rows = df.select(
        "tokens", "tags", "doc_id", F.lit(source).alias("source"), F.col("avg_confidence").alias("confidence")
    )
    replace_folder(path, lambda fresh: rows.write.json(fresh))


def feature_rules(df: DataFrame) -> dict[str, Column]:
    """Row rules of the feature table; a rule holds where its column is true."""
    words = F.col("word_count")
    return {
        "doc_id_present": F.col("doc_id").isNotNull(),
        "text_present": F.coalesce(F.length("text_clean") > 0, F.lit(False)),
        "word_count_in_range": F.coalesce(words.between(5, 2000), F.lit(False)),
        "filtered_words_not_empty": F.coalesce(F.size("filtered_words") > 0, F.lit(False)),
    }


def validate_output(df: DataFrame, required: list[str], rules: dict[str, Column], key: str = "doc_id") -> DataFrame:
    """One row per rule: rows checked, violations, passed.

    Row rules and repeated keys are counted in one shuffle by key, combined
    before it, so one key repeated many times is no burden. Missing columns are
    reported by the rule ``schema``; then nothing else can be checked.
    """
    missing = [c for c in required if c not in df.columns]
    if missing:
        count = F.lit(len(missing)).cast("bigint")
        return df.agg(F.count(F.lit(1)).alias("checked")).select(
            F.lit("schema").alias("rule"), "checked", count.alias("violations"), F.lit(False).alias("passed")
        )
    broken = {name: F.when(rule, 0).otherwise(1) for name, rule in rules.items()}
    per_key = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(name) for name, c in broken.items()]
    )
    totals = per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("checked"),
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in broken],
        F.coalesce(F.sum(F.when(F.col(key).isNotNull(), F.col("_n") - 1)), F.lit(0)).alias(f"{key}_unique"),
        F.lit(0).cast("bigint").alias("schema"),
    )
    names = ["schema", *broken, f"{key}_unique"]
    rows = F.array([F.struct(F.lit(n).alias("rule"), F.col(n).alias("violations")) for n in names])
    return totals.select("checked", F.inline(rows)).select(
        "rule", "checked", "violations", (F.col("violations") == 0).alias("passed")
    )
