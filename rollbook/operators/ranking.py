"""Row numbers within a key that do not gather the key in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollbook.session import cut_lineage, land

_INDEX_BITS = 33  # low bits of monotonically_increasing_id: row within partition


def rank_within(df: DataFrame, keys: list[str], order: list[Column], name: str) -> DataFrame:
    """Add the 1-based position of each row within its key, in ``order``.

    The rows are landed, as the sort samples them first, then range-partitioned and sorted by (key, order), so a hot key
    runs over as many partitions as it needs. The sorted rows are checkpointed,
    which fixes their places; a row's position is then its place in its
    partition plus the rows of the key in earlier partitions (one row per key
    and partition). ``order`` must end in a tie-breaker that makes it total.
    """
    placed = cut_lineage(land(df, "unranked").orderBy(*[F.asc_nulls_last(k) for k in keys], *order)).withColumn(
        "_place", F.monotonically_increasing_id()
    )
    placed = placed.withColumn("_part", F.shiftright("_place", _INDEX_BITS))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = (
        placed.groupBy(*keys, "_part")
        .agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .select(*[F.col(k).alias(f"_run_{k}") for k in keys], F.col("_part").alias("_run_part"), "_first", "_before")
    )
    on = F.col("_part") == F.col("_run_part")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_run_{k}"))
    return placed.join(runs, on).select(
        *df.columns, (F.col("_before") + F.col("_place") - F.col("_first") + 1).cast("int").alias(name)
    )
