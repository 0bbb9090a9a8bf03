"""Session settings and shared folders."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "corpuslab", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, Arrow and UTC.

    Shuffle partitions are only fixed for a local master; on a cluster they
    come from the deployment and are coalesced by adaptive execution.
    """
    builder = SparkSession.builder.appName(app)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if master is not None:
        builder = builder.master(master)
        if master.startswith("local"):
            settings["spark.sql.shuffle.partitions"] = "8"
            settings["spark.ui.enabled"] = "false"
            settings["spark.driver.memory"] = "12g"
            settings["spark.ui.showConsoleProgress"] = "false"
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A local master without the setting gets a temporary folder; a cluster
    without it is an error, since a machine-local folder would be lost with
    its machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="corpuslab-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written table below the shared folder."""
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if _jobs:
        _jobs[-1].append(path)
    return path


_jobs: list[list[str]] = []


@contextmanager
def scratch_tables() -> Iterator[None]:
    """Delete the scratch tables made inside the block at its end. Nothing that
    leaves the block may read them: a job returns what it has written as output."""
    paths: list[str] = []
    _jobs.append(paths)
    try:
        yield
    finally:
        _jobs.remove(paths)
        for path in paths:
            drop_table(path)


def store_of(path: str):
    """The file system of a shared folder or file, and the path inside it."""
    from pyarrow import fs

    if "://" in path and not path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")


def drop_table(path: str) -> None:
    """Delete a scratch table that nothing reads any more, if it was written."""
    store, root = store_of(path)
    with suppress(FileNotFoundError):
        store.delete_dir(root)


def via_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Used where several jobs read one expensive result: the lineage is cut by
    files that outlive any executor.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
