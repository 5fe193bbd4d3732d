"""Landed JSON pages of people to the cleaned table of their appointments."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollbook.functions.text import strip_all
from rollbook.operators.changes import stable_id
from rollbook.operators.cleaning import PAGE_COLUMNS, clean_content
from rollbook.operators.gates import Gate, Measures, publish
from rollbook.sources.payloads import attach_owner, flatten, parse_payload, unreadable


def page_schema() -> T.StructType:
    """The part of a page that is read."""
    organisation = (
        "struct<content_id: string, title: string, analytics_identifier: string, details: struct<acronym: string>>"
    )
    role = (
        "struct<content_id: string, title: string, document_type: string,"
        f" links: struct<ordered_parent_organisations: array<{organisation}>>>"
    )
    appointment = (
        "struct<content_id: string, details: struct<started_on: string, ended_on: string>,"
        f" links: struct<role: array<{role}>>>"
    )
    return T.StructType.fromDDL(
        "content_id string, details struct<full_name: string>,"
        f" links struct<available_translations: array<struct<locale: string>>, role_appointments: array<{appointment}>>"
    )


def flat_pages(lookup: DataFrame, raw: DataFrame, measures: Measures | None = None, random_ids: bool = False) -> DataFrame:
    """(lookup: id, slug; raw: slug, payload) to one row per leaf, strings stripped, with a row id.

    The id is a hash of the row, so a retried task makes the same one and equal rows share it; ``random_ids``
    gives every row its own, for a table written once. Pages that do not read are left out (``set_aside``).
    ``measures`` counts the pages owned, read and flattened.
    """
    watch = measures.watch if measures else lambda _, df: df
    owned = watch("owned", attach_owner(lookup, raw, "slug", "id", "owner_id").drop("slug"))
    read = watch("read", parse_payload(owned, page_schema()))
    flat = strip_all(flatten(read))
    row_id = F.uuid() if random_ids else stable_id(*[F.col(f"`{c}`") for c in PAGE_COLUMNS])
    return watch("flat", flat.select(row_id.alias("row_id"), *[F.col(f"`{c}`") for c in flat.columns]))


def set_aside(raw: DataFrame) -> DataFrame:
    """Landed pages that are no JSON, or whose fields have other types than are read, with the ``reason``."""
    return unreadable(raw, page_schema())


def unlanded(lookup: DataFrame, raw: DataFrame) -> DataFrame:
    """Rows of the lookup whose page was never landed, and which ``flat_pages`` therefore lacks."""
    return lookup.join(raw.select("slug").distinct(), "slug", "left_anti")


def clean_pages(lookup: DataFrame, raw: DataFrame, measures: Measures | None = None, **options) -> DataFrame:
    return clean_content(flat_pages(lookup, raw, measures), **options)


def publish_pages(lookup: DataFrame, raw: DataFrame, path: str, run: str | datetime.date, **options) -> dict[str, int]:
    """Clean the landed pages and publish them as a run, if every page of the lookup was landed and reads."""
    measures = Measures()
    asked = lookup.count()
    gate = Gate({
        "every page landed": lambda m: m["owned.rows"] == asked,
        "every page reads": lambda m: m["read.rows"] == m["owned.rows"],
    })
    return publish(clean_pages(lookup, raw, measures, **options), path, run, gate, measures)
