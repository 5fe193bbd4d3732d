"""Change sets as SQL text for the core database, one statement per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.functions.rules import seniority_group
from rollbook.functions.text import escape_quotes

PROLOGUE = "set noexec on"


def literal(value: Column) -> Column:
    """Quoted text, quotes doubled; NULL for a missing value."""
    return F.coalesce(F.concat(F.lit("'"), escape_quotes(value.cast("string")), F.lit("'")), F.lit("NULL"))


def equals(column: str, value: Column) -> Column:
    """Comparison that also finds a missing value."""
    return F.when(value.isNull(), F.lit(f"{column} is null")).otherwise(
        F.concat(F.lit(f"{column} = "), literal(value))
    )


def _all(*tests: Column) -> Column:
    return F.concat_ws(" and ", *tests)


def _office(alias: str) -> list[Column]:
    return [
        equals(f"{alias}.short_name", F.col("organisation_short_name")),
        equals(f"{alias}.start_date", F.col("organisation_start_date")),
        equals(f"{alias}.end_date", F.col("organisation_end_date")),
    ]


def insert_posts(changes: DataFrame) -> DataFrame:
    return changes.withColumn(
        "statement",
        F.format_string(
            "insert into core.post (id, organisation_id, name, rank_equivalence)"
            " select newid(), o.id, %s, %s from core.organisation o where %s;",
            literal(F.col("post_name")),
            literal(F.col("post_rank")),
            _all(*_office("o")),
        ),
    )


def insert_relationships(changes: DataFrame) -> DataFrame:
    return changes.withColumn(
        "statement",
        F.format_string(
            "insert into core.post_relationship (id, post_id, group_name, group_seniority)"
            " select newid(), t.id, %s, %s from core.post t"
            " inner join core.organisation o on t.organisation_id = o.id where %s;",
            literal(F.col("group_name")),
            literal(seniority_group(F.col("post_rank"))),
            _all(equals("t.name", F.col("post_name")), equals("t.rank_equivalence", F.col("post_rank")), *_office("o")),
        ),
    )


def update_appointments(resolved: DataFrame) -> DataFrame:
    """For resolved edits: the target rows are known, so the statement names them."""
    return resolved.withColumn(
        "statement",
        F.format_string(
            "update core.appointment set post_id = %s where %s;",
            literal(F.col("new_post_id")),
            equals("id", F.col("target_appointment_id")),
        ),
    )
