"""Reading and writing tables: snapshots by run, match sheets, scripts."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollbook.contracts import MATCH_SHEET, cast_to_contract
from rollbook.session import land, scratch


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_database(
    spark: SparkSession, url: str, table: str, key: str, low: int, high: int, tasks: int, **options: str
) -> DataFrame:
    """A table of a database, read by ``tasks`` tasks over ranges of a numeric key."""
    bounds = {"partitionColumn": key, "lowerBound": low, "upperBound": high, "numPartitions": tasks}
    return spark.read.format("jdbc").options(url=url, dbtable=table, **bounds, **options).load()


def write_snapshot(
    df: DataFrame, path: str, run: str | datetime.date, contract: T.StructType | None = None, partition: str = "run_date"
) -> None:
    """Replace one run's partition and leave the others alone."""
    out = df if contract is None else cast_to_contract(df, contract)
    (
        out.withColumn(partition, F.lit(run))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


def read_snapshot(
    spark: SparkSession, path: str, run: str | datetime.date | None = None, partition: str = "run_date"
) -> DataFrame:
    """One run, by partition pruning, or all of them."""
    df = spark.read.parquet(path)
    return df if run is None else df.filter(F.col(partition) == F.lit(run)).drop(partition)


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


def write_buckets(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """Write a table that must not exist yet, cut by a hash of ``key`` into folders that can be replaced one by one."""
    cut = df.withColumn("bucket", _bucket(key, buckets)).repartition(buckets, "bucket")
    cut.write.mode("errorifexists").partitionBy("bucket").parquet(path)


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("bucket")


def rewrite_buckets(
    spark: SparkSession, path: str, key: str, buckets: int, changed_keys: DataFrame, change: Callable[[DataFrame], DataFrame]
) -> int:
    """Replace the buckets that hold one of ``changed_keys`` by ``change`` of their rows; all others keep their files.

    ``changed_keys`` has the column ``key``. ``change`` gets the rows of the touched buckets only and must return
    the same columns, and keys that it did not have only where they belong to those buckets. The new buckets
    are landed first, so that nothing is read while it is replaced. Returns the number of buckets replaced.
    """
    touched = [r["bucket"] for r in changed_keys.select(_bucket(key, buckets).alias("bucket")).distinct().collect()]
    if not touched:
        return 0
    rows = spark.read.parquet(path).filter(F.col("bucket").isin(touched)).drop("bucket")
    with scratch(spark):
        new = land(change(rows).select(*rows.columns), "new-buckets").withColumn("bucket", _bucket(key, buckets))
        (
            new.repartition(len(touched), "bucket")
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)
        )
    return len(touched)


def write_once(df: DataFrame, path: str, contract: T.StructType | None = None) -> None:
    """Write a table that must not exist yet."""
    out = df if contract is None else cast_to_contract(df, contract)
    out.write.mode("errorifexists").parquet(path)


def rewrite(df: DataFrame, path: str, input_path: str) -> None:
    """Replace a table. Spark reads while it writes, so input and output must differ."""
    if path.rstrip("/") == input_path.rstrip("/"):
        raise ValueError("write the new version to another path")
    df.write.mode("overwrite").parquet(path)


def match_sheet(matches: DataFrame) -> DataFrame:
    """Matches with the sheet's columns, the three review columns blank."""
    blank = F.lit(None).cast("string")
    filled = matches.withColumns({"accept": blank, "replacement_name": blank, "replacement_slug": blank})
    return cast_to_contract(filled, MATCH_SHEET)


def write_match_sheet(matches: DataFrame, path: str) -> None:
    match_sheet(matches).orderBy("df_left_id", "duplicate_flag_df_left").write.mode("errorifexists").csv(
        path, header=True
    )


def read_match_sheet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=MATCH_SHEET, enforceSchema=False)


def write_script(statements: DataFrame, path: str, prologue: str, order: list[str]) -> None:
    """The prologue, then the ``statement`` column in the order of ``order``, one per line."""
    head = statements.sparkSession.range(1).select(F.lit(0).alias("_body"), F.lit(prologue).alias("statement"))
    lines = head.unionByName(statements.withColumn("_body", F.lit(1)), allowMissingColumns=True)
    lines.orderBy("_body", *order).select("statement").write.mode("errorifexists").text(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line, value) of a written text, numbered from 1 in the order it was written.

    A writer's files are named in that order; a large one is read in several pieces. Within a task ``_at`` rises by one a
    line and a piece is read in one go, so a line's number is its place in its piece plus the lines of all pieces before. The lines are
    landed, which fixes the pieces.
    """
    lines = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_name").alias("_file"), F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_at"), "value"
    )
    lines = land(lines, "lines-read")
    piece = ["_file", "_start"]
    earlier = Window.orderBy(*piece).rowsBetween(Window.unboundedPreceding, -1)
    sizes = lines.groupBy(*piece).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    sizes = sizes.select(*piece, "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    return lines.join(sizes, piece).select((F.col("_before") + F.col("_at") - F.col("_first") + 1).alias("line"), "value")
