"""From flattened page content to the cleaned table of appointments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.contracts import PAGE_CONTENT, cast_to_contract
from rollbook.functions import fixed_rules as fixed
from rollbook.functions.dates import longer_than_a_day, parse_date
from rollbook.functions.rules import first_match
from rollbook.functions.titles import normalise_titles

# Dotted column of the page content -> column of the cleaned table
_ROLE = "links.role_appointments.links.role"
_PARENT = f"{_ROLE}.links.ordered_parent_organisations"
PAGE_COLUMNS = {
    "owner_id": "person_id",
    "content_id": "person_id_ext",
    "details.full_name": "person_name",
    "links.role_appointments.content_id": "appointment_id_ext",
    f"{_ROLE}.content_id": "post_id_ext",
    f"{_ROLE}.title": "post_name",
    f"{_PARENT}.content_id": "organisation_id_ext",
    f"{_PARENT}.title": "organisation_name",
    f"{_PARENT}.details.acronym": "organisation_short_name",
    "links.role_appointments.details.started_on": "appointment_start_date",
    "links.role_appointments.details.ended_on": "appointment_end_date",
    "links.available_translations.locale": "locale",
    f"{_ROLE}.document_type": "document_type",
    f"{_PARENT}.analytics_identifier": "analytics_identifier",
}


def page_rows(flat: DataFrame) -> DataFrame:
    """Flattened page content under short names."""
    return flat.select(*[F.col(f"`{path}`").alias(name) for path, name in PAGE_COLUMNS.items()])


def keep_ministerial(rows: DataFrame) -> DataFrame:
    """Rows of one locale, of ministerial roles and of departments."""
    organisation, tag, title = F.col("organisation_name"), F.col("analytics_identifier"), F.col("post_name")
    return rows.filter(
        (F.col("locale") == fixed.KEPT_LOCALE)
        & (F.col("document_type") == fixed.KEPT_DOCUMENT_TYPE)
        & ~title.isin(*fixed.DROPPED_TITLES)
        & (tag.isNull() | tag.startswith(fixed.DEPARTMENT_PREFIX) | organisation.isin(*fixed.KEPT_ORGANISATIONS))
        & (organisation.isNull() | ~organisation.isin(*fixed.DROPPED_ORGANISATIONS))
    )


def page_content(rows: DataFrame) -> DataFrame:
    """The 18 columns of the contract, distinct; columns filled later are blank."""
    blank = ["post_name_clean", "post_rank", "leave_reason", "organisation_name_clean", "organisation_short_name_clean"]
    dates = ["appointment_start_date", "appointment_end_date"]
    filled = rows.withColumns(
        {
            **{c: parse_date(F.col(c).cast("string")) for c in dates},
            **{c: F.lit(None).cast("string") for c in blank},
            "is_on_leave": F.lit(False),
            "is_acting": F.lit(False),
        }
    )
    return cast_to_contract(filled, PAGE_CONTENT).distinct()


def drop_short_spells(df: DataFrame, start: str = "appointment_start_date", end: str = "appointment_end_date") -> DataFrame:
    """Without spells of a day or less; open spells stay."""
    return df.filter(longer_than_a_day(F.col(start), F.col(end)))


def short_spells(df: DataFrame, start: str = "appointment_start_date", end: str = "appointment_end_date") -> DataFrame:
    return df.filter(F.datediff(F.col(end), F.col(start)) <= 1)


def clean_names(df: DataFrame, collation: str | None = None) -> DataFrame:
    """Fill the three ``*_clean`` columns from the raw ones, in one projection."""
    return df.withColumns(
        {
            "post_name_clean": first_match(fixed.POST_NAME_RULES, F.col("post_name"), collation),
            "organisation_name_clean": first_match(
                fixed.ORGANISATION_NAME_RULES, F.col("organisation_name"), collation
            ),
            "organisation_short_name_clean": first_match(
                fixed.ORGANISATION_SHORT_NAME_RULES, F.col("organisation_short_name"), collation
            ),
        }
    )


def clean_content(flat: DataFrame, collation: str | None = None, fix_known_defects: bool = False) -> DataFrame:
    """Filters, rule tables and title normalisers; one shuffle, for the distinct."""
    content = drop_short_spells(page_content(keep_ministerial(page_rows(flat))))
    return normalise_titles(clean_names(content, collation), fix_known_defects=fix_known_defects)
