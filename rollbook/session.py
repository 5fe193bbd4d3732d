"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "20000",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def build_session(app: str = "rollbook", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings the operators assume.

    Shuffle partitions are left to the cluster (AQE coalesces them); pass
    ``extra`` for local runs.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only where that is unset and the master is local does a temporary folder
    stand in for it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="rollbook-")
    context.setCheckpointDir(folder)
    return folder


# paths made inside the innermost ``scratch`` block of this thread or task
_owned: ContextVar[list[str] | None] = ContextVar("owned", default=None)


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no earlier run has used."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    owned = _owned.get()
    if owned is not None:
        owned.append(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a landed table, in whatever file system it lies."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Owns the tables landed inside the block and deletes them at its end.

    Results that read them have to be written or counted before.
    """
    made: list[str] = []
    outer = _owned.set(made)
    try:
        yield
    finally:
        _owned.reset(outer)
        for path in made:
            remove(spark, path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder (survives lost executors)."""
    context = df.sparkSession.sparkContext
    folder = shared_folder(df.sparkSession)
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def land(df: DataFrame, name: str, arrow_rows: int | None = None) -> DataFrame:
    """Write a result that several later steps read, and go on from the written table.

    The table lies in the shared folder, so it survives lost executors, and its
    file sizes let Spark choose later joins by real size. While it is written, Arrow
    steps get at most ``arrow_rows`` rows at once, or what the session says.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    before = spark.conf.get(ARROW_ROWS)
    fewer = arrow_rows and not 0 < int(before) <= arrow_rows
    if fewer:
        spark.conf.set(ARROW_ROWS, arrow_rows)
    try:
        df.write.mode("errorifexists").parquet(path)
    finally:
        if fewer:
            spark.conf.set(ARROW_ROWS, before)
    return spark.read.schema(df.schema).parquet(path)
