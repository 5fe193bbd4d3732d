"""Review of scored candidates: decisions taken, and the lists a reviewer reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.functions.fixed_rules import MANY_NAMED_TITLES

CANDIDATE = ["appointment_id_core", "appointment_id_ext"]
DECISIONS = ["reviewed", "match_accepted", "replace_post_name", "notes"]
LISTED = [
    *DECISIONS, "appointment_id_core", "person_name_core", "post_name_core", "organisation_short_name_core",
    "start_date_core", "end_date_core", "post_name_ext", "organisation_short_name_ext", "start_date_ext", "end_date_ext",
]


def apply_decisions(workflow: DataFrame, decisions: DataFrame) -> DataFrame:
    """Overwrite the flags of the candidates decided on; a null decision keeps the flag.

    ``decisions``: one row per candidate, with any of the four flag columns.
    """
    given = [c for c in DECISIONS if c in decisions.columns]
    renamed = decisions.select(*CANDIDATE, *[F.col(c).alias(f"_{c}") for c in given])
    joined = workflow.join(renamed, CANDIDATE, "left")
    return joined.select(
        *[F.coalesce(f"_{c}", c).alias(c) if c in given else F.col(c) for c in workflow.columns]
    )


def ambiguous_appointments(workflow: DataFrame) -> DataFrame:
    """Ids of appointments accepted under more than one listed post name."""
    return (
        workflow.filter(F.col("match_accepted") & ~F.col("post_name_core").isin(*MANY_NAMED_TITLES))
        .groupBy("appointment_id_core")
        .agg(F.count_distinct("post_name_ext").alias("n"))
        .filter(F.col("n") > 1)
        .select("appointment_id_core")
    )


def renames(workflow: DataFrame) -> DataFrame:
    """Reviewed, accepted rows to be renamed, of appointments that are not ambiguous."""
    chosen = workflow.filter(F.col("reviewed") & F.col("match_accepted") & F.col("replace_post_name"))
    return chosen.join(ambiguous_appointments(workflow), "appointment_id_core", "left_anti")


def ambiguous_rows(workflow: DataFrame) -> DataFrame:
    chosen = workflow.filter(F.col("reviewed") & F.col("match_accepted"))
    return (
        chosen.join(ambiguous_appointments(workflow), "appointment_id_core", "left_semi")
        .select(*_present(workflow, LISTED + ["match_score"]))
    )


def without_accepted(workflow: DataFrame) -> DataFrame:
    """Reviewed rows of appointments with no accepted candidate."""
    accepted = workflow.filter("match_accepted").select("appointment_id_core").distinct()
    scores = [
        "organisation_short_name_match", "post_name_match", "start_date_match", "end_date_match", "date_match", "match_score",
    ]
    return (
        workflow.filter("reviewed")
        .join(accepted, "appointment_id_core", "left_anti")
        .select(*_present(workflow, LISTED + scores))
    )


def with_notes(workflow: DataFrame) -> DataFrame:
    return workflow.filter(F.col("reviewed") & F.col("notes").isNotNull()).select(
        *_present(workflow, LISTED + ["match_score"])
    )


def rank_differences(workflow: DataFrame) -> DataFrame:
    """Distinct rows to be renamed whose two ranks differ; a missing rank is no difference."""
    columns = ["post_rank_core", "post_rank_ext", *LISTED, "match_score"]
    return (
        renames(workflow)
        .filter(F.col("post_rank_core") != F.col("post_rank_ext"))
        .select(*_present(workflow, columns))
        .distinct()
    )


def planned_renames(workflow: DataFrame) -> DataFrame:
    return renames(workflow).select(
        "post_name_core", "post_name_ext", "organisation_short_name_core", "organisation_short_name_ext",
        "post_rank_core", "post_rank_ext",
    ).distinct()


def in_review_order(listing: DataFrame, *last: str) -> DataFrame:
    """The listings' order: person, appointment, then ``last``; nulls first."""
    return listing.orderBy(*[F.asc_nulls_first(c) for c in ("person_name_core", "appointment_id_core", *last)])


def _present(df: DataFrame, columns: list[str]) -> list[str]:
    return [c for c in columns if c in df.columns]
