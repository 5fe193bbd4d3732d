"""Joins on validity intervals, and the check that intervals do not overlap.

Three conventions, kept apart:
- half open, both ends may be open (``point_in_validity``)
- half open, a row without a start never matches (``guard_start=False``)
- closed, an interval within an interval (``interval_contained``)
"""

from __future__ import annotations

from functools import reduce
from typing import Literal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollbook.functions.dates import or_earliest, or_latest
from rollbook.operators.skew import PAIR_BUDGET
from rollbook.session import land

BUCKET_DAYS = 366
# the calendar that hot keys are cut along; dates outside fall into the end buckets
_FIRST_DAY, _LAST_DAY = "1900-01-01", "2100-01-01"


def _bucket(date: Column) -> Column:
    inside = F.least(F.greatest(date, F.lit(_FIRST_DAY).cast("date")), F.lit(_LAST_DAY).cast("date"))
    return F.floor(F.datediff(inside, F.lit(_FIRST_DAY).cast("date")) / F.lit(BUCKET_DAYS)).cast("int")


def key_dates(facts: DataFrame, key: str, at: str) -> DataFrame:
    """Rows of every key, and the calendar years its dates lie in: ``key, n, first, last``.

    One row a key, so it is small next to the facts.
    """
    return facts.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"), _bucket(F.min(at)).alias("first"), _bucket(F.max(at)).alias("last"))


def keys_to_cut(
    facts: DataFrame, key: str, at: str, steps: list[tuple[DataFrame, str, DataFrame | None]], pair_budget: int = PAIR_BUDGET
) -> list[DataFrame | None]:
    """The keys of every step of a chain that have too many (date, interval) pairs, or None if there are none.

    A step is (intervals, their key, links): without links its key is ``key`` of the facts; with links, rows (key of
    the facts, key of the step), each key of the step has at most the rows of the fact's key it belongs to.
    The facts are counted once, by a job whose result is landed (one row a key); a second job looks for intervals
    whose key could reach the budget with the most frequent key of the facts, and only if there are any are they
    joined to the keys they belong to. So the plan of a chain holds neither side a second time.
    """
    dates = land(key_dates(facts, key, at), "key-dates")
    most = dates.agg(F.max("n")).first()[0] or 0
    many = [
        intervals.groupBy(F.col(own).cast("string").alias("key")).agg(F.count(F.lit(1)).alias("m"))
        .filter(F.col("m").cast("double") * most > F.lit(float(pair_budget))).select(F.lit(number).alias("step"), "key", "m")
        for number, (intervals, own, _) in enumerate(steps)
    ]
    many = land(reduce(DataFrame.unionByName, many), "many-intervals")
    found = {r["step"] for r in many.select("step").distinct().collect()}
    return [_hot(dates, many.filter(F.col("step") == number), step, pair_budget) if number in found else None for number, step in enumerate(steps)]


def _hot(dates: DataFrame, many: DataFrame, step: tuple[DataFrame, str, DataFrame | None], pair_budget: int) -> DataFrame | None:
    intervals, own, links = step
    by_key = many.select(F.col("key").cast(intervals.schema[own].dataType).alias("_hot_key"), "m")
    if links is None:
        met = by_key.join(dates, F.col("_hot_key") == F.col("key"))
    else:
        old, new = links.columns
        met = by_key.join(links, F.col("_hot_key") == F.col(new)).join(dates, F.col(old) == F.col("key"))
    over = met.filter(F.col("n").cast("double") * F.col("m") > F.lit(float(pair_budget)))
    hot = land(over.groupBy("_hot_key").agg(F.min("first").alias("_first"), F.max("last").alias("_last")), "hot-keys")
    return None if hot.isEmpty() else hot


def point_in_validity(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    at: str,
    start: str,
    end: str,
    guard_start: bool = True,
    how: str = "inner",
    pair_budget: int = PAIR_BUDGET,
    cut: DataFrame | None | Literal["count"] = "count",
) -> DataFrame:
    """Rows of ``left`` with the rows of ``right`` that were valid on ``at``.

    The two sides must not share column names. A key with more than
    ``pair_budget`` pairs of a date and an interval is cut along the calendar: its
    intervals go to every year they touch between its first and its last date,
    and each left row looks only into its own year. Other keys have the single
    bucket 0, so nothing is copied for them; without a key to cut this is a
    plain join on the key. ``cut`` is one of the results of ``keys_to_cut``; by
    default it is counted here, by a job over both sides.
    """
    if how not in {"inner", "left"}:
        raise ValueError("how must be 'inner' or 'left'")
    if isinstance(cut, str):
        cut = keys_to_cut(left, left_key, at, [(right, right_key, None)], pair_budget)[0]
    since, until = or_earliest(F.col(start)) if guard_start else F.col(start), or_latest(F.col(end))
    on = (F.col(left_key) == F.col(right_key)) & (F.col(at) >= since) & (F.col(at) < until)
    if cut is None:
        return left.join(right, on, how)
    is_hot = F.col("_hot_key").isNotNull()
    points = left.join(cut, F.col(left_key) == F.col("_hot_key"), "left").select(
        *left.columns, F.when(is_hot, _bucket(F.col(at))).otherwise(0).alias("_at_bucket")
    )
    first, last = F.greatest(_bucket(since), F.col("_first")), F.least(_bucket(until), F.col("_last"))
    years = (
        F.when(is_hot & (since <= until) & (first <= last), F.sequence(first, last))
        .when(is_hot, F.array().cast("array<int>"))
        .otherwise(F.array(F.lit(0)))
    )
    spans = right.join(cut, F.col(right_key) == F.col("_hot_key"), "left").select(
        *right.columns, F.explode(years).alias("_in_bucket")
    )
    return points.join(spans, on & (F.col("_at_bucket") == F.col("_in_bucket")), how).drop("_at_bucket", "_in_bucket")


def interval_contained(
    left: DataFrame,
    right: DataFrame,
    keys: list[tuple[str, str]],
    left_start: str,
    left_end: str,
    right_start: str,
    right_end: str,
    how: str = "left",
) -> DataFrame:
    """Rows of ``left`` with the rows of ``right`` whose closed interval holds theirs."""
    on = (F.col(left_start) >= or_earliest(F.col(right_start))) & (
        or_latest(F.col(left_end)) <= or_latest(F.col(right_end))
    )
    for own, other in keys:
        on = (F.col(own) == F.col(other)) & on
    return left.join(right, on, how)


def overlaps(df: DataFrame, key: str, row_id: str, start: str, end: str) -> DataFrame:
    """Rows whose interval runs into the next one of the same key, with ``next_start``.

    Next means next by (start, row_id). Rows that share a start are the next of
    one another, but for the last; only that one looks ahead, over the key's
    distinct starts. So no window ever holds more than one row per day and key.
    """
    days = df.groupBy(key, start).agg(F.max(row_id).alias("_last"))
    ahead = Window.partitionBy(key).orderBy(F.asc_nulls_first(start))
    days = days.select(
        F.col(key).alias("_key"), F.col(start).alias("_start"), "_last", F.lead(start).over(ahead).alias("_next")
    )
    same = (F.col(key).eqNullSafe(F.col("_key"))) & (F.col(start).eqNullSafe(F.col("_start")))
    following = F.when(F.col(row_id) == F.col("_last"), F.col("_next")).otherwise(F.col(start))
    return (
        df.join(days, same)
        .withColumn("next_start", following)
        .filter(F.col("next_start") < or_latest(F.col(end)))
        .select(*df.columns, "next_start")
    )


def any_overlap(df: DataFrame, key: str, start: str, end: str) -> bool:
    """Whether two rows of a key hold on the same day; a row without a start, or that ends by its start, holds on none.

    So a left join on ``point_in_validity(guard_start=False)`` can repeat a left row only if this is true.
    """
    held = df.filter(F.col(key).isNotNull() & (F.col(start) < or_latest(F.col(end))))
    days = held.groupBy(key, start).agg(F.count(F.lit(1)).alias("_n"), F.max(or_latest(F.col(end))).alias("_until"))
    following = F.lead(start).over(Window.partitionBy(key).orderBy(start))
    return not days.withColumn("_next", following).filter((F.col("_n") > 1) | (F.col("_next") < F.col("_until"))).isEmpty()
