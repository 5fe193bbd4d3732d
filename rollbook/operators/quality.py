"""Data checks. Each is a DataFrame of findings, computed by aggregation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duplicates(df: DataFrame, keys: list[str], count: str = "count") -> DataFrame:
    """Key groups of more than one row. Nulls form a group."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count)).filter(F.col(count) > 1)


def rows_in_duplicate_groups(df: DataFrame, group: list[str], match: list[str]) -> DataFrame:
    """Rows that agree in ``match`` with some duplicate group by ``group``."""
    groups = duplicates(df, group).select(*match).distinct()
    return df.join(groups, match, "left_semi")


def orphans(df: DataFrame, key: str, where: Column, twin: Column) -> DataFrame:
    """Rows under ``where`` that no row under ``twin`` shares its key with."""
    twins = df.filter(twin).select(F.col(key).alias("_twin")).distinct()
    return df.filter(where).join(twins, F.col(key) == F.col("_twin"), "left_anti")


def uniqueness(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, rows, distinct_values, is_unique) for each column."""
    # one aggregation over (column, value) pairs: exact, and it never gathers
    # a column's values in one task
    pairs = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])
        ).alias("p")
    ).select("p.*")
    counted = pairs.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    return (
        counted.groupBy("column_name")
        .agg(F.sum("n").alias("rows"), F.count("value").alias("distinct_values"))
        .withColumn("is_unique", F.col("rows") == F.col("distinct_values"))
    )


def length_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: the longest value of each string column."""
    return df.agg(*[F.max(F.length(c)).alias(f"max_{c}_length") for c in columns])


def all_start_with(df: DataFrame, column: str, prefix: str) -> DataFrame:
    """One row: whether every non-null value has the prefix, and how many do not."""
    wrong = F.count_if(~F.col(column).startswith(prefix))
    return df.agg(wrong.alias("violations"), (wrong == 0).alias("holds"))


def row_counts(**frames: DataFrame) -> DataFrame:
    """One row: the size of each frame and whether all agree."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n") for name, df in frames.items()
    ]
    stacked = reduce(DataFrame.unionByName, counts)
    sizes = [F.max(F.when(F.col("name") == name, F.col("n"))).alias(f"{name}_rows") for name in frames]
    return stacked.agg(*sizes, (F.min("n") == F.max("n")).alias("rows_agree"))


def count_targets(changes: DataFrame, targets: DataFrame, on: Column, change_id: list[str], target: str) -> DataFrame:
    """``change_id`` with the number of targets each change finds, none included."""
    return changes.join(targets, on, "left").groupBy(*change_id).agg(F.count(target).alias("n_targets"))


def split_by_cardinality(counted: DataFrame, expected: int = 1) -> tuple[DataFrame, DataFrame]:
    """(changes to go ahead with, changes to set aside): every change is in one of them."""
    good = F.col("n_targets") == expected
    return counted.filter(good), counted.filter(~good)
