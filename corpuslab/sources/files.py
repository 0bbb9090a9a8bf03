"""Text files, metric reports, request logs, experiment logs and load-test results."""

from __future__ import annotations

from functools import reduce
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from corpuslab.functions.text import trim_all
from corpuslab.session import store_of, via_table

REQUEST_LOG = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("level", T.StringType()),
        T.StructField("logger", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("request_id", T.StringType()),
        T.StructField("trace_id", T.StringType()),
        T.StructField("model_version", T.StringType()),
        T.StructField("latency_ms", T.DoubleType()),
        T.StructField("entity_counts", T.MapType(T.StringType(), T.IntegerType())),
        T.StructField("input_length", T.IntegerType()),
        T.StructField("status_code", T.IntegerType()),
        T.StructField("error_type", T.StringType()),
    ]
)

EXPERIMENT_LOG = T.StructType(
    [
        T.StructField("sample_id", T.LongType()),
        T.StructField("assigned_group", T.StringType()),
        T.StructField("latency_a_ms", T.DoubleType()),
        T.StructField("latency_b_ms", T.DoubleType()),
        T.StructField("accuracy_a", T.DoubleType()),
        T.StructField("accuracy_b", T.DoubleType()),
        T.StructField("f1_a", T.DoubleType()),
        T.StructField("f1_b", T.DoubleType()),
        T.StructField("num_tokens", T.LongType()),
        T.StructField("correct_a", T.LongType()),
        T.StructField("correct_b", T.LongType()),
    ]
)

LOAD_TEST = T.StructType(
    [
        T.StructField("request_id", T.StringType()),
        T.StructField("latency_ms", T.DoubleType()),
        T.StructField("num_entities", T.IntegerType()),
        T.StructField("num_tokens", T.IntegerType()),
        T.StructField("status", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)

EMPTY_FILE = "File is empty"
#: Listings write an empty authority as three slashes, rows as one.
SLASHES = "^([a-z0-9]+):///"
NESTED = "map<string,string>"
#: Files of these endings are unpacked by Spark's reader.
PACKED = ("bz2", "deflate", "gz", "lz4", "snappy", "zst", "zstd")
#: Files and bytes that one task reads, and bytes of a batch.
TASK_FILES, TASK_BYTES, BATCH_BYTES = 2_000, 64 << 20, 4 << 20


def _hidden(name: str) -> bool:
    """Whether Spark's readers pass over a file or folder of this name."""
    if name.startswith(("_metadata", "_common_metadata")):
        return False
    return name.startswith(".") or name.endswith("._COPYING_") or (name.startswith("_") and "=" not in name)


def _listable(path: str) -> bool:
    """Whether tasks can list ``path``; file systems and patterns that only
    Spark's readers know are left to them."""
    if any(c in path for c in "*?[{"):
        return False
    try:
        store, root = store_of(path)
        return store.get_file_info(root).type != fs.FileType.NotFound
    except (ValueError, OSError, pa.ArrowException):
        return False


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """``path`` and ``size`` of all files below ``path``, hidden ones left out.

    Each round lists the folders that the one before found, in tasks, so the
    driver holds no names.
    """
    root = store_of(path)[1].rstrip("/")
    given = path.rstrip("/")
    prefix = given[: len(given) - len(root)] if "://" in path and not path.startswith("file:") and given.endswith(root) else "file:"
    schema = "path string, size bigint, folder boolean"

    def listed(batches):
        for batch in batches:
            found = []
            for name in batch.column("path").to_pylist():
                store, root = store_of(name)
                info = store.get_file_info(root)
                inside = store.get_file_info(fs.FileSelector(root)) if info.type == fs.FileType.Directory else [info]
                for entry in inside:
                    if not _hidden(entry.base_name):
                        found.append((prefix + entry.path, entry.size, entry.type == fs.FileType.Directory))
            kinds = (pa.string(), pa.int64(), pa.bool_())
            columns = [pa.array([f[i] for f in found], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=["path", "size", "folder"])

    level = via_table(spark.createDataFrame([(path,)], "path string").mapInArrow(listed, schema), "listing")
    out = level.filter("NOT folder").select("path", "size")
    while not (folders := level.filter("folder")).isEmpty():
        tasks = spark.sparkContext.defaultParallelism
        level = via_table(folders.select("path").repartition(tasks).mapInArrow(listed, schema), "listing")
        out = out.unionByName(level.filter("NOT folder").select("path", "size"))
    return out


def _contents(batches):
    """The bytes of the listed files, in batches of bounded size."""

    def batch_of(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary())], names=["path", "value"]
        )

    for batch in batches:
        rows, held = [], 0
        for name in batch.column("path").to_pylist():
            store, root = store_of(name)
            with store.open_input_stream(root, compression=None) as stream:
                value = stream.read()
            if rows and held + len(value) > BATCH_BYTES:
                yield batch_of(rows)
                rows, held = [], 0
            # Readers write names as in addresses.
            rows.append((quote(name, safe="/!$&'()*+,;=:@~-._"), value))
            held += len(value)
        if rows:
            yield batch_of(rows)


def _whole_files(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """``path`` and ``text`` of the files that Spark's reader lists; none for those of no bytes."""
    content = spark.read.options(recursiveFileLookup="true", **options).text(path, wholetext=True)
    return content.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def _listed_by_reader(spark: SparkSession, path: str) -> DataFrame:
    """The files with their texts where Spark's reader has to list them."""
    names = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    listed = [(name,) for name in spark.read.text(path, wholetext=True).inputFiles()] if path_exists(spark, path) else []
    every = spark.createDataFrame(listed, "path string").select(F.regexp_replace("path", SLASHES, "$1:/").alias("path"))
    known = names.select(F.regexp_replace("path", SLASHES, "$1:/").alias("path"))
    empty = every.join(known, "path", "left_anti").select("path", F.lit("").alias("text"))
    return _whole_files(spark, path).unionByName(empty)


def _listed_by_tasks(spark: SparkSession, path: str) -> DataFrame:
    """The files with their texts, listed and read in tasks."""
    found = list_files(spark, path)
    n, size, packed = found.agg(
        F.count(F.lit(1)),
        F.coalesce(F.sum("size"), F.lit(0)),
        F.count_if(F.substring_index("path", ".", -1).isin(*PACKED) & (F.col("size") > 0)),
    ).first()
    # A packed file of no bytes is empty like any other.
    plain = found.filter(~F.substring_index("path", ".", -1).isin(*PACKED) | (F.col("size") == 0)) if packed else found
    tasks = max(spark.sparkContext.defaultParallelism, n // TASK_FILES, size // TASK_BYTES)
    paths = via_table(plain.select("path").repartition(tasks), "files")
    texts = paths.mapInArrow(_contents, "path string, value binary").select("path", F.col("value").cast("string").alias("text"))
    if not packed:
        return texts
    return texts.unionByName(_whole_files(spark, path, pathGlobFilter=f"*.{{{','.join(PACKED)}}}"))


def read_text_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per file with its trimmed text, or an error for an empty one.

    Tasks share the listing, folder by folder, and then the files, so that
    neither the number of files nor that of folders is felt by the driver.
    """
    every = _listed_by_tasks(spark, path) if _listable(path) else _listed_by_reader(spark, path)
    trimmed = every.select("path", trim_all(F.col("text")).alias("text"))
    empty = F.length("text") == 0
    return trimmed.select(
        "path",
        F.when(~empty, F.col("text")).alias("text"),
        F.when(empty, F.lit(EMPTY_FILE)).alias("error"),
    )


def _is_nested(value: Column) -> Column:
    return F.coalesce(value.startswith("{"), F.lit(False))


def flatten_reports(reports: DataFrame, report: str = "report") -> DataFrame:
    """JSON reports to (…, variant, metric, value) rows, numbers only.

    A number at the top has no variant (""), one inside a section has the
    section's name, one that lies deeper the names below the section, joined by
    dots. Levels are unfolded until nothing nested is left; beyond three of
    them each takes a look at the reports.
    """
    keys = [c for c in reports.columns if c != report]
    first = F.from_json(report, NESTED)
    rows = reports.select(*keys, F.array().cast("array<string>").alias("_path"), F.explode(first).alias("_key", "_value"))
    level = 1
    while level < 3 or not rows.filter(_is_nested(F.col("_value"))).isEmpty():
        inside = F.from_json(F.when(_is_nested(F.col("_value")), F.col("_value")), NESTED)
        # A number stays as it is; only what is unfolded gets a longer path.
        below = F.transform(
            F.map_entries(inside),
            lambda e: F.struct(
                F.concat("_path", F.array("_key")).alias("_path"), e["key"].alias("_key"), e["value"].alias("_value")
            ),
        )
        kept = F.array(F.struct("_path", "_key", "_value"))
        rows = rows.select(*keys, F.inline(F.coalesce(below, kept)))
        level += 1
    variant = F.when(F.size("_path") > 1, F.array_join(F.slice("_path", 2, F.size("_path")), ".")).otherwise(
        F.coalesce(F.get("_path", F.lit(0)), F.lit(""))
    )
    value = F.expr("try_cast(_value AS DOUBLE)")
    found = rows.select(*keys, variant.alias("variant"), F.col("_key").alias("metric"), value.alias("value"))
    return found.filter(F.col("value").isNotNull())


def path_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def read_reports(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Reports of all components in long form. ``paths`` maps a component to
    its files; what does not exist is left out, and nothing at all is an error."""
    present = {c: p for c, p in paths.items() if path_exists(spark, p)}
    if not present:
        raise FileNotFoundError("no reports found")
    frames = [
        spark.read.option("recursiveFileLookup", "true")
        .text(path, wholetext=True)
        .select(
            F.lit(component).alias("component"),
            F.col("_metadata.file_path").alias("path"),
            F.col("value").alias("report"),
        )
        for component, path in present.items()
    ]
    return flatten_reports(reduce(DataFrame.unionByName, frames))


def read_request_log(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Log lines of all files; a line that is not JSON keeps its text in ``corrupt``."""
    reader = spark.readStream if streaming else spark.read
    schema = T.StructType([*REQUEST_LOG.fields, T.StructField("corrupt", T.StringType())])
    return reader.schema(schema).option("columnNameOfCorruptRecord", "corrupt").json(path)


def parse_request_log(lines: DataFrame, line: str = "value") -> DataFrame:
    """Parse JSON log lines; a line that is not JSON keeps its text in ``corrupt``."""
    schema = T.StructType([*REQUEST_LOG.fields, T.StructField("corrupt", T.StringType())])
    parsed = F.from_json(F.col(line), schema, {"columnNameOfCorruptRecord": "corrupt"})
    return lines.withColumn("_log", parsed).select(*[c for c in lines.columns if c != line], "_log.*")


def read_experiment_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, schema=EXPERIMENT_LOG, header=True)


def write_experiment_log(df: DataFrame, path: str) -> None:
    df.select(*EXPERIMENT_LOG.fieldNames()).write.mode("overwrite").csv(path, header=True)


def read_load_test(spark: SparkSession, path: str) -> DataFrame:
    """Result files, each a JSON array; many files are read in parallel."""
    return spark.read.option("recursiveFileLookup", "true").json(path, schema=LOAD_TEST, multiLine=True)
