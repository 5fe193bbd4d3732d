"""Change sets: what to add to and alter in the core tables, and applying it."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.functions.dates import or_earliest, or_latest, undo_frozen_end
from rollbook.functions.names import post_topic
from rollbook.functions.rules import preferred_rank, seniority_group
from rollbook.operators.quality import split_by_cardinality
from rollbook.operators.review import renames
from rollbook.operators.validity import interval_contained, point_in_validity

NEW_POST = ["post_name", "post_rank", "organisation_short_name", "organisation_start_date", "organisation_end_date"]
EDIT = [
    "appointment_id", "person_name", "post_name_old", "post_name_new", "post_rank_old", "post_rank_new",
    "organisation_short_name", "start_date", "end_date",
]


def stable_id(*parts: Column) -> Column:
    """Id from the natural key: a retried task makes the same one."""
    return F.sha2(F.concat_ws("\u001f", *[F.coalesce(p.cast("string"), F.lit("\u0000")) for p in parts]), 256)


def _wanted_posts(workflow: DataFrame) -> DataFrame:
    """Distinct new titles with rank, organisation and the spell they are wanted for."""
    return (
        renames(workflow)
        .select(
            F.col("post_name_ext").alias("post_name"),
            preferred_rank(F.col("post_rank_ext"), F.col("post_rank_core")).alias("post_rank"),
            F.col("organisation_short_name_core").alias("organisation_short_name"),
            F.col("start_date_core").alias("_start"),
            F.col("end_date_core").alias("_end"),
        )
        .distinct()
    )


def _without_existing(wanted: DataFrame, existing: DataFrame, organisation: DataFrame) -> DataFrame:
    """Drop titles that exist under the rank and organisation, then date the organisation."""
    key = ["post_name", "post_rank", "organisation_short_name"]
    missing = wanted.join(existing.select(*key).distinct(), key, "left_anti")
    dated = organisation.select(
        F.col("short_name").alias("_short_name"),
        F.col("start_date").alias("organisation_start_date"),
        F.col("end_date").alias("organisation_end_date"),
    )
    return (
        interval_contained(
            missing, dated, [("organisation_short_name", "_short_name")], "_start", "_end",
            "organisation_start_date", "organisation_end_date",
        )
        .select(*NEW_POST)
        .distinct()
    )


def _posts_by_key(post: DataFrame, organisation: DataFrame) -> DataFrame:
    offices = organisation.select(
        F.col("id").alias("organisation_id"), F.col("short_name").alias("organisation_short_name"),
        F.col("start_date").alias("organisation_start_date"), F.col("end_date").alias("organisation_end_date"),
    )
    named = post.select(
        F.col("id").alias("post_id"), "organisation_id", F.col("name").alias("post_name"),
        F.col("rank_equivalence").alias("post_rank"),
    )
    return named.join(offices, "organisation_id")


def posts_to_add(workflow: DataFrame, post: DataFrame, organisation: DataFrame) -> DataFrame:
    """Titles to be introduced that the organisation does not have under that rank."""
    return _without_existing(_wanted_posts(workflow), _posts_by_key(post, organisation), organisation)


def relationships_to_add(
    workflow: DataFrame, post_relationship: DataFrame, post: DataFrame, organisation: DataFrame
) -> DataFrame:
    """Titles to be introduced that belong to no group yet, with the group proposed for them."""
    grouped = _posts_by_key(post, organisation).join(
        post_relationship.select("post_id").distinct(), "post_id", "left_semi"
    )
    missing = _without_existing(_wanted_posts(workflow), grouped, organisation)
    return missing.withColumn("group_name", post_topic(F.col("post_name")))


def in_change_order(changes: DataFrame, *columns: str) -> DataFrame:
    return changes.orderBy(*[F.asc_nulls_first(c) for c in columns])


def appointments_to_edit(workflow: DataFrame, frozen_as_of: datetime.date | None = None) -> DataFrame:
    """Appointments to move to another title, once per spell."""
    return (
        renames(workflow)
        .select(
            F.col("appointment_id_core").alias("appointment_id"),
            F.col("person_name_core").alias("person_name"),
            F.col("post_name_core").alias("post_name_old"),
            F.col("post_name_ext").alias("post_name_new"),
            F.col("post_rank_core").alias("post_rank_old"),
            preferred_rank(F.col("post_rank_ext"), F.col("post_rank_core")).alias("post_rank_new"),
            F.col("organisation_short_name_core").alias("organisation_short_name"),
            F.col("start_date_core").alias("start_date"),
            undo_frozen_end(F.col("end_date_core"), frozen_as_of).alias("end_date"),
        )
        .distinct()
    )


def _null_safe(pairs: list[tuple[str, str]]) -> Column:
    on = F.lit(True)
    for a, b in pairs:
        on = on & F.col(a).eqNullSafe(F.col(b))
    return on


def resolve_new_posts(to_add: DataFrame, organisation: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(posts to insert, posts whose organisation is not exactly one)."""
    offices = organisation.select(
        F.col("id").alias("_office"), F.col("short_name").alias("_short_name"),
        F.col("start_date").alias("_since"), F.col("end_date").alias("_until"),
    )
    same = _null_safe(
        [
            ("organisation_short_name", "_short_name"), ("organisation_start_date", "_since"),
            ("organisation_end_date", "_until"),
        ]
    )
    counted = (
        to_add.join(offices, same, "left")
        .groupBy(*NEW_POST)
        .agg(F.count("_office").alias("n_targets"), F.min("_office").alias("organisation_id"))
    )
    good, aside = split_by_cardinality(counted)
    rows = good.select(
        stable_id(*[F.col(c) for c in NEW_POST]).alias("id"), "organisation_id",
        F.col("post_name").alias("name"), F.col("post_rank").alias("rank_equivalence"),
    )
    return rows, aside.drop("organisation_id")


def add_posts(post: DataFrame, new_posts: DataFrame) -> DataFrame:
    """The post table with the new rows; ids become strings."""
    columns = ["id", "organisation_id", "name", "rank_equivalence"]
    return post.select(*columns).withColumn("id", F.col("id").cast("string")).unionByName(new_posts.select(*columns))


def resolve_new_relationships(
    to_add: DataFrame, post: DataFrame, organisation: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """(relationships to insert, those whose post is not exactly one). Run after ``add_posts``."""
    posts = _posts_by_key(post, organisation).select("post_id", *[F.col(c).alias(f"_{c}") for c in NEW_POST])
    counted = (
        to_add.join(posts, _null_safe([(c, f"_{c}") for c in NEW_POST]), "left")
        .groupBy(*NEW_POST, "group_name")
        .agg(F.count("post_id").alias("n_targets"), F.min("post_id").alias("post_id"))
    )
    good, aside = split_by_cardinality(counted)
    rows = good.select(
        stable_id(*[F.col(c) for c in NEW_POST], F.col("group_name")).alias("id"), "post_id", "group_name",
        seniority_group(F.col("post_rank")).alias("group_seniority"),
    )
    return rows, aside.drop("post_id")


def add_relationships(post_relationship: DataFrame, new_rows: DataFrame) -> DataFrame:
    columns = ["id", "post_id", "group_name", "group_seniority"]
    kept = post_relationship.select(*columns).withColumns(
        {"id": F.col("id").cast("string"), "post_id": F.col("post_id").cast("string")}
    )
    return kept.unionByName(new_rows.select(*columns).withColumn("post_id", F.col("post_id").cast("string")))


def edit_targets(
    edits: DataFrame, appointment: DataFrame, spell: DataFrame, person: DataFrame, post: DataFrame, organisation: DataFrame
) -> DataFrame:
    """The appointments and new posts each edit finds by its natural key, one row per hit.

    The whole change set is resolved in one pass: held posts by (person, title,
    rank, organisation, spell), new posts by (title, rank, organisation). The
    appointment's dates must lie within the old organisation, the spell's
    within the new one.
    """
    wanted = edits.select(*[F.col(c).alias(f"e_{c}") for c in EDIT])

    offices = organisation.select(
        F.col("id").alias("office_id"), F.col("short_name").alias("office"),
        F.col("start_date").alias("office_since"), F.col("end_date").alias("office_until"),
    )
    posts = post.select(
        F.col("id").alias("post_key"), F.col("organisation_id").alias("post_office"),
        F.col("name").alias("post_title"), F.col("rank_equivalence").alias("post_level"),
    ).join(offices, F.col("post_office") == F.col("office_id"))

    held = appointment.select(
        F.col("id").alias("a_id"), F.col("person_id").alias("a_person"), F.col("post_id").alias("a_post"),
        F.col("start_date").alias("a_start"), F.col("end_date").alias("a_end"),
    )
    people = person.select(
        F.col("id").alias("p_id"), F.col("name").alias("p_name"),
        F.col("start_date").alias("p_since"), F.col("end_date").alias("p_until"),
    )
    # only people that some edit names
    named = wanted.select(F.col("e_person_name").alias("n_name")).distinct()
    people = people.join(named, F.col("p_name").eqNullSafe(F.col("n_name")), "left_semi")
    held = point_in_validity(held, people, "a_person", "p_id", "a_start", "p_since", "p_until")
    held = interval_contained(
        held, posts, [("a_post", "post_key")], "a_start", "a_end", "office_since", "office_until", how="inner"
    ).select("a_id", "p_name", "post_title", "post_level", "office")
    spells = spell.select(
        F.col("appointment_id").alias("s_appointment"), F.col("start_date").alias("s_start"), F.col("end_date").alias("s_end")
    )
    held = held.join(spells, F.col("a_id") == F.col("s_appointment"))

    found = wanted.join(
        held,
        _null_safe(
            [
                ("e_person_name", "p_name"), ("e_post_name_old", "post_title"), ("e_post_rank_old", "post_level"),
                ("e_organisation_short_name", "office"), ("e_start_date", "s_start"), ("e_end_date", "s_end"),
            ]
        ),
    ).select(*wanted.columns, "a_id", "s_start", "s_end")

    new_posts = posts.select(
        F.col("post_key").alias("new_post_id"), F.col("post_title").alias("new_title"), F.col("post_level").alias("new_level"),
        F.col("office").alias("new_office"), F.col("office_since").alias("new_since"), F.col("office_until").alias("new_until"),
    )
    fits = (F.col("s_start") >= or_earliest(F.col("new_since"))) & (
        or_latest(F.col("s_end")) <= or_latest(F.col("new_until"))
    )
    return found.join(
        new_posts,
        _null_safe(
            [
                ("e_post_name_new", "new_title"), ("e_post_rank_new", "new_level"),
                ("e_organisation_short_name", "new_office"),
            ]
        )
        & fits,
    ).select(
        *[F.col(f"e_{c}").alias(c) for c in EDIT], F.col("a_id").alias("target_appointment_id"), "new_post_id"
    )


def resolve_edits(edits: DataFrame, targets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(edits with one target each, edits to set aside with their number of targets)."""
    hits = targets.groupBy(*EDIT).agg(
        F.count(F.lit(1)).alias("_hits"),
        F.min("target_appointment_id").alias("target_appointment_id"),
        F.min("new_post_id").alias("new_post_id"),
    )
    renamed = hits.select(
        *[F.col(c).alias(f"h_{c}") for c in EDIT], "_hits", "target_appointment_id", "new_post_id"
    )
    counted = edits.join(renamed, _null_safe([(c, f"h_{c}") for c in EDIT]), "left").select(
        *EDIT, F.coalesce("_hits", F.lit(0)).cast("long").alias("n_targets"), "target_appointment_id", "new_post_id"
    )
    good, aside = split_by_cardinality(counted)
    return good, aside.drop("target_appointment_id", "new_post_id")


def apply_edits(appointment: DataFrame, resolved: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(appointments with the new posts, edits of one appointment that disagree).

    Edits that name different posts for one appointment are not applied.
    """
    moves = resolved.groupBy(F.col("target_appointment_id").alias("_move")).agg(
        F.min("new_post_id").alias("_post"), F.max("new_post_id").alias("_other")
    )
    agreed = moves.filter(F.col("_post") == F.col("_other")).select("_move", "_post")
    clashes = moves.filter(F.col("_post") != F.col("_other")).select(F.col("_move").alias("target_appointment_id"))
    moved = appointment.join(agreed, F.col("id") == F.col("_move"), "left").select(
        *[F.coalesce("_post", "post_id").alias("post_id") if c == "post_id" else F.col(c) for c in appointment.columns]
    )
    return moved, resolved.join(clashes, "target_appointment_id", "left_semi")
