"""Joins that stay spread out when one key holds a large share of the rows."""

from __future__ import annotations

from math import ceil, isqrt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAIR_BUDGET = 4_000_000  # pairs one key may produce in one task
MOST_PARTITIONS = 100_000  # tasks a driver can keep track of in one stage


def fan_out(df: DataFrame, *columns: str, least: int = 0) -> DataFrame:
    """Hash rows over the shuffle partitions, ahead of a step far heavier than its input.

    AQE sizes partitions by bytes and would fold a small input that multiplies
    into a few tasks; a given partition count it leaves alone. The count is one
    more than the session's, or Spark would drop the step as a repeat of an
    equal shuffle before it, and at least ``least``. A join or grouping on the same
    columns uses the partitioning as it is.
    """
    count = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) + 1
    return df.repartition(max(count, least), *columns)


def key_sizes(df: DataFrame, keys: list[str], name: str = "rows_per_key") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def spread_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    pair_budget: int = PAIR_BUDGET,
    left_sizes: DataFrame | None = None,
    right_sizes: DataFrame | None = None,
    work: float | None = None,
) -> DataFrame:
    """Inner m:n equi-join; a key over ``pair_budget`` pairs becomes a grid.

    Such a key is cut into blocks of about sqrt(pair_budget) rows on both
    sides, by a hash of the row; each left block meets each right block in its
    own (key, row block, column block) group. All pairs of the plain join come
    out, each exactly once. There are at most (rows left + rows right) /
    sqrt(pair_budget) such keys; whether their table is broadcast is left to
    Spark's own size check.

    ``left_sizes``/``right_sizes``: rows per key, named ``rows_per_key``; pass
    them where a cheaper count (or an upper bound) than scanning the input is
    known. Counting the work, the number of pairs, is a job of its own unless it is given.
    """
    block = max(1, isqrt(pair_budget))
    n_left = (left_sizes if left_sizes is not None else key_sizes(left, keys)).withColumnRenamed(
        "rows_per_key", "_n_left"
    )
    n_right = (right_sizes if right_sizes is not None else key_sizes(right, keys)).withColumnRenamed(
        "rows_per_key", "_n_right"
    )
    met = n_left.join(n_right, keys)
    # partitions by the work to be done: about a budget of pairs each, however many rows there are
    if work is None:
        work = met.agg(F.sum(F.col("_n_left").cast("double") * F.col("_n_right"))).first()[0] or 0.0
    partitions = min(ceil(work / pair_budget), MOST_PARTITIONS)
    grids = (
        met.filter(F.col("_n_left").cast("double") * F.col("_n_right") > F.lit(float(pair_budget)))
        .select(
            *keys,
            F.ceil(F.col("_n_left") / F.lit(block)).cast("int").alias("_rows"),
            F.ceil(F.col("_n_right") / F.lit(block)).cast("int").alias("_cols"),
        )
    )

    def cut(df: DataFrame, own: str, other: str, own_block: str, other_block: str) -> DataFrame:
        columns = df.columns
        placed = df.join(grids, keys, "left").select(
            *columns,
            F.coalesce(F.pmod(F.xxhash64(*columns), F.col(own)), F.lit(0)).cast("int").alias(own_block),
            F.coalesce(F.col(other), F.lit(1)).alias("_copies"),
        )
        return placed.select(
            *columns, own_block, F.explode(F.sequence(F.lit(0), F.col("_copies") - 1)).alias(other_block)
        )

    blocks = [*keys, "_row_block", "_col_block"]
    left_cut = fan_out(cut(left, "_rows", "_cols", "_row_block", "_col_block"), *blocks, least=partitions)
    right_cut = fan_out(cut(right, "_cols", "_rows", "_col_block", "_row_block"), *blocks, least=partitions)
    return left_cut.join(right_cut, blocks).drop("_row_block", "_col_block")
