"""Weighted linkage of two sets of appointments of the same people."""

from __future__ import annotations

import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.contracts import WORKFLOW
from rollbook.functions.dates import proximity
from rollbook.functions.similarity import title_similarity, without_the
from rollbook.operators.skew import PAIR_BUDGET, spread_join
from rollbook.session import land

# Weights and limits of the score
ORGANISATION_WEIGHT, POST_WEIGHT, DATE_WEIGHT = 0.3, 0.5, 0.2
ORGANISATION_MISS = 0.5
ACCEPT_SCORE = 1.0
ACCEPT_DATE = 0.8
# a date score of 0.8 leaves no room for starts further apart than this
_ACCEPT_DAYS = 40

_SHARED = [
    "person_name", "post_name", "post_rank", "organisation_short_name",
    "is_on_leave", "is_acting", "leave_reason", "start_date", "end_date",
]


def _date_score(start: Column, end: Column) -> Column:
    # this order of operations decides borderline cases
    return start * F.lit(0.5) + end * F.lit(0.5)


def _side(df: DataFrame, suffix: str, as_of: datetime.date) -> DataFrame:
    """Suffix the overlapping columns; add the title without "the" and the end used for scoring."""
    renamed = df.withColumnsRenamed({c: f"{c}{suffix}" for c in ["appointment_id", *_SHARED] if c in df.columns})
    return renamed.withColumns(
        {
            f"_short{suffix}": without_the(F.col(f"post_name{suffix}")),
            f"_until{suffix}": F.coalesce(F.col(f"end_date{suffix}"), F.lit(as_of)),
        }
    )


def appointments_with_sure_match(core: DataFrame, ext: DataFrame, own: str, other: str) -> DataFrame:
    """Distinct ids of core appointments that have an accepted candidate.

    Acceptance asks for equal organisations and a title score of 1, that is
    equal titles up to "the", so it is an equi-join on person, organisation and
    title: no similarity is computed and no pair of the m:n join is formed.
    Starts must lie within 40 days, so they join by 41-day step and its neighbours.
    """
    step = lambda date: F.floor(F.datediff(date, F.lit(datetime.date(1970, 1, 1))) / F.lit(_ACCEPT_DAYS + 1))
    keys = [("person_id", "person_id"), ("organisation_short_name",) * 2, ("_short",) * 2]
    left = core.select(
        F.col(f"appointment_id{own}").alias("appointment_id"),
        F.col("person_id").alias("l_person"),
        F.col(f"organisation_short_name{own}").alias("l_organisation"),
        F.col(f"_short{own}").alias("l_title"),
        F.col(f"start_date{own}").alias("l_start"),
        F.col(f"_until{own}").alias("l_until"),
        step(F.col(f"start_date{own}")).alias("l_step"),
    ).distinct()
    right = (
        ext.select(
            F.col("person_id").alias("r_person"),
            F.col(f"organisation_short_name{other}").alias("r_organisation"),
            F.col(f"_short{other}").alias("r_title"),
            F.col(f"start_date{other}").alias("r_start"),
            F.col(f"_until{other}").alias("r_until"),
        )
        .distinct()
        .withColumn("r_step", F.explode(F.array(*[step(F.col("r_start")) + F.lit(i) for i in (-1, 0, 1)])))
    )
    on = (
        (F.col("l_person") == F.col("r_person"))
        & (F.col("l_organisation") == F.col("r_organisation"))
        & (F.col("l_title") == F.col("r_title"))
        & (F.col("l_step") == F.col("r_step"))
        & (
            _date_score(
                proximity(F.col("l_start"), F.col("r_start")), proximity(F.col("l_until"), F.col("r_until"))
            )
            >= ACCEPT_DATE
        )
    )
    return left.join(right, on, "left_semi").select("appointment_id").distinct()


class _Sizes(NamedTuple):
    """Rows and distinct titles of every person on both sides, and the pairs of each that they make."""

    table: DataFrame
    row_pairs: float
    title_pairs: float

    def side(self, number: int, column: str) -> DataFrame:
        return self.table.filter(F.col(f"{column}_{number}").isNotNull()).select("person_id", F.col(f"{column}_{number}").alias("rows_per_key"))


def person_sizes(left: DataFrame, right: DataFrame, own: str, other: str) -> _Sizes:
    counted = [
        side.groupBy("person_id").agg(F.count(F.lit(1)).alias(f"rows_{number}"), F.count_distinct(F.col(f"post_name{suffix}")).alias(f"titles_{number}"))
        for number, (side, suffix) in enumerate(((left, own), (right, other)))
    ]
    table = land(counted[0].join(counted[1], "person_id"), "person-sizes")
    pairs = [F.coalesce(F.sum(F.col(f"{c}_0").cast("double") * F.col(f"{c}_1")), F.lit(0.0)).alias(c) for c in ("rows", "titles")]
    return _Sizes(table, *table.agg(*pairs).first())


def titles_repeat(left: DataFrame, right: DataFrame, own: str, other: str, sizes: _Sizes) -> bool:
    """Whether scoring distinct title pairs saves at least half of the scoring.

    Compares the pairs of rows with two upper bounds on the pairs of titles: those of each person's distinct
    titles, and all titles of one side with all of the other.
    """
    if not sizes.row_pairs or 2 * sizes.title_pairs <= sizes.row_pairs:
        return bool(sizes.row_pairs)
    titles = left.select(F.lit(0).alias("side"), F.col(f"post_name{own}").alias("t")).unionByName(right.select(F.lit(1).alias("side"), F.col(f"post_name{other}").alias("t")))
    kinds = [r["n"] for r in titles.groupBy("side").agg(F.count_distinct("t").alias("n")).collect()]
    return len(kinds) == 2 and 2 * kinds[0] * kinds[1] <= sizes.row_pairs


def scored_titles(left: DataFrame, right: DataFrame, own: str, other: str, sizes: _Sizes, pair_budget: int = PAIR_BUDGET) -> DataFrame:
    """Every pair of titles that some person has on both sides, once, with its similarity: ``_own_title, _other_title, _score``.

    Pairs are formed of each person's distinct titles and made distinct over all persons before they are scored.
    """
    owned = left.select("person_id", F.col(f"post_name{own}").alias("_own_title")).dropna().distinct()
    offered = right.select("person_id", F.col(f"post_name{other}").alias("_other_title")).dropna().distinct()
    pairs = spread_join(owned, offered, ["person_id"], pair_budget, sizes.side(0, "titles"), sizes.side(1, "titles"), sizes.title_pairs)
    titles = pairs.select("_own_title", "_other_title").distinct()
    a, b = F.col("_own_title"), F.col("_other_title")
    return titles.select(a, b, title_similarity(a, b, without_the(a), without_the(b)).alias("_score"))


def score_candidates(
    core: DataFrame,
    ext: DataFrame,
    as_of: datetime.date,
    suffixes: tuple[str, str] = ("_core", "_ext"),
    pair_budget: int = PAIR_BUDGET,
) -> DataFrame:
    """Every pair of appointments of the same person, scored, with the 33 result columns.

    ``as_of`` stands in for a missing end while scoring only. All rows of a core
    appointment are marked reviewed when any of its candidates is accepted; that
    set is found before the pairs are formed, so the scored pairs need no further
    shuffle. Both sides are read several times (sure matches, rows per person,
    titles, pairs), so they are landed first. Where titles repeat, each distinct
    pair of titles is scored once, and the pairs of appointments look the score up.
    """
    own, other = suffixes
    left = land(_side(core, own, as_of), "match-core")
    right = land(_side(ext, other, as_of), "match-ext")
    sizes = person_sizes(left, right, own, other)
    once = titles_repeat(left, right, own, other, sizes)
    titles = land(scored_titles(left, right, own, other, sizes, pair_budget), "title-scores") if once else None
    sure = appointments_with_sure_match(left, right, own, other).select(F.col("appointment_id").alias("_sure"))
    left = left.join(sure, F.col(f"appointment_id{own}") == F.col("_sure"), "left").withColumn(
        "reviewed", F.col("_sure").isNotNull()
    ).drop("_sure")

    pairs = spread_join(left, right, ["person_id"], pair_budget, sizes.side(0, "rows"), sizes.side(1, "rows"), sizes.row_pairs)
    if titles is not None:
        by_title = (F.col(f"post_name{own}") == F.col("_own_title")) & (F.col(f"post_name{other}") == F.col("_other_title"))
        pairs = pairs.join(titles, by_title, "left")

    def both(name: str) -> tuple[Column, Column]:
        return F.col(f"{name}{own}"), F.col(f"{name}{other}")

    organisation_own, organisation_other = both("organisation_short_name")
    scored = pairs.withColumns(
        {
            "organisation_short_name_match": F.when(organisation_own == organisation_other, 1.0).otherwise(
                ORGANISATION_MISS
            ),
            "post_name_match": title_similarity(*both("post_name"), *both("_short")) if titles is None else F.col("_score"),
            "start_date_match": proximity(*both("start_date")),
            "end_date_match": proximity(*both("_until")),
        }
    ).withColumn("date_match", _date_score(F.col("start_date_match"), F.col("end_date_match")))
    scored = scored.withColumn(
        "match_score",
        F.col("organisation_short_name_match") * F.lit(ORGANISATION_WEIGHT)
        + F.col("post_name_match") * F.lit(POST_WEIGHT)
        + F.col("date_match") * F.lit(DATE_WEIGHT),
    )
    accepted = (F.col("match_score") >= ACCEPT_SCORE) | (
        (F.col("organisation_short_name_match") == 1)
        & (F.col("post_name_match") == 1)
        & (F.col("date_match") >= ACCEPT_DATE)
    )
    flagged = scored.withColumns(
        {
            "match_accepted": F.coalesce(accepted, F.lit(False)),
            "replace_post_name": F.lit(False),
            "notes": F.lit(None).cast("string"),
        }
    )
    columns = [
        c.removesuffix("_core") + own if c.endswith("_core") else c.removesuffix("_ext") + other if c.endswith("_ext") else c
        for c in WORKFLOW.fieldNames()
    ]
    return flagged.select(*columns)


def for_export(scored: DataFrame, suffix: str = "_core", last: tuple[str, ...] = ()) -> DataFrame:
    """Rows in the order a reviewer reads them; ``last`` decides between candidates of the same score."""
    return scored.orderBy(
        F.asc_nulls_last(f"person_name{suffix}"),
        F.asc_nulls_last(f"appointment_id{suffix}"),
        F.desc_nulls_last("match_score"),
        *last,
    )
