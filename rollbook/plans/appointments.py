"""Appointments of the core database against the cleaned listing: score, review, change."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.contracts import by_value
from rollbook.functions.rules import house_to_kind
from rollbook.operators.matching import score_candidates
from rollbook.operators.skew import PAIR_BUDGET
from rollbook.operators.validity import any_overlap, keys_to_cut, point_in_validity


def core_appointments(
    appointment: DataFrame,
    spell: DataFrame,
    person: DataFrame,
    representation: DataFrame | None,
    post: DataFrame,
    organisation: DataFrame,
    min_start: datetime.date | None = None,
    representation_spell: DataFrame | None = None,
    pair_budget: int = PAIR_BUDGET,
) -> DataFrame:
    """Spells of appointments with person, house, post and organisation as of the start.

    The floor on the spell's start goes first, so that it reaches the scan.
    ``representation=None`` leaves the kind of member blank and saves its join.
    ``representation_spell`` adds no column; it repeats rows where several of its
    spells hold, so its join is planned only if a check finds two that overlap.
    Keys with too many (date, interval) pairs are found by one job before the
    joins, from the facts as they are then. Identifiers that are strings compare
    without regard to case, and come out in lower case.
    """
    appointment, spell = by_value(appointment, "id", "person_id", "post_id"), by_value(spell, "appointment_id")
    person, post, organisation = by_value(person, "id"), by_value(post, "id", "organisation_id"), by_value(organisation, "id")
    if representation is not None:
        representation = by_value(representation, "id", "person_id")
    if representation_spell is not None:
        representation_spell = by_value(representation_spell, "representation_id")
        if not any_overlap(representation_spell, "representation_id", "start_date", "end_date"):
            representation_spell = None
    if min_start is not None:
        spell = spell.filter(F.col("start_date") >= F.lit(min_start))
    base = appointment.select(
        F.col("id").alias("appointment_id"), F.col("person_id").alias("a_person"), F.col("post_id").alias("a_post"),
        F.col("start_date").alias("a_start"),
    )
    spells = spell.select(
        F.col("appointment_id").alias("s_appointment"), "cabinet_status", "is_on_leave", "is_acting", "leave_reason",
        "start_date", "end_date",
    )
    rows = base.join(spells, F.col("appointment_id") == F.col("s_appointment"))
    people = person.select(
        F.col("id").alias("person_id"), F.col("name").alias("person_name"), F.col("start_date").alias("p_since"),
        F.col("end_date").alias("p_until"),
    )
    steps = [(people, "person_id", None)]
    if representation is not None:
        seats = representation.select(
            F.col("id").alias("r_id"), F.col("person_id").alias("r_person"), "house", F.col("start_date").alias("r_since"),
            F.col("end_date").alias("r_until"),
        )
        steps.append((seats, "r_person", None))
        if representation_spell is not None:
            seat_spells = representation_spell.select(
                F.col("representation_id").alias("rc_id"), F.col("start_date").alias("rc_since"), F.col("end_date").alias("rc_until")
            )
            steps.append((seat_spells, "rc_id", seats.select(F.col("r_person").alias("_old"), F.col("r_id").alias("_new"))))
    cuts = keys_to_cut(rows, "a_person", "a_start", steps, pair_budget)
    rows = point_in_validity(rows, people, "a_person", "person_id", "a_start", "p_since", "p_until", cut=cuts[0])
    kind = F.lit(None).cast("string")
    if representation is not None:
        kind = house_to_kind(F.col("house"))
        rows = point_in_validity(rows, seats, "a_person", "r_person", "a_start", "r_since", "r_until", False, "left", cut=cuts[1])
    if len(steps) == 3:
        rows = point_in_validity(rows, seat_spells, "r_id", "rc_id", "a_start", "rc_since", "rc_until", False, "left", cut=cuts[2])
    posts = post.select(
        F.col("id").alias("t_id"), "organisation_id", F.col("name").alias("post_name"),
        F.col("rank_equivalence").alias("post_rank"),
    )
    offices = organisation.select(F.col("id").alias("o_id"), F.col("short_name").alias("organisation_short_name"))
    return (
        rows.join(posts, F.col("a_post") == F.col("t_id"))
        .join(offices, F.col("organisation_id") == F.col("o_id"))
        .select(
            "appointment_id", "person_id", "person_name", kind.alias("mp_peer"), "post_name",
            "organisation_short_name", "post_rank", "cabinet_status", "is_on_leave", "is_acting", "leave_reason",
            "start_date", "end_date",
        )
    )


def listed_appointments(page_content: DataFrame) -> DataFrame:
    """The cleaned page content as the other side of the match."""
    return by_value(page_content, "person_id").select(
        F.col("appointment_id_ext").alias("appointment_id"), "person_id", "person_name",
        F.col("post_name_clean").alias("post_name"), "post_rank", "is_on_leave", "is_acting", "leave_reason",
        F.col("organisation_short_name_clean").alias("organisation_short_name"),
        F.col("appointment_start_date").alias("start_date"), F.col("appointment_end_date").alias("end_date"),
    )


def match(core: DataFrame, page_content: DataFrame, as_of: datetime.date) -> DataFrame:
    """Scored candidates, ready to be written under a run id and reviewed."""
    return score_candidates(core, listed_appointments(page_content), as_of)
