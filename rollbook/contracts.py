"""Schemas at the boundaries, and the cast to them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _schema(text: str) -> T.StructType:
    names = {
        "string": T.StringType(), "date": T.DateType(), "double": T.DoubleType(),
        "boolean": T.BooleanType(), "int": T.IntegerType(),
    }
    fields = []
    for part in text.replace("\n", " ").split(","):
        name, kind = part.split()
        fields.append(T.StructField(name, names[kind]))
    return T.StructType(fields)


PEOPLE_STRINGS = _schema("id string, name string, slug string")

MATCH_SHEET = _schema(
    """df_left_id string, df_right_id string, duplicate_flag_df_left int, match_score double,
    name_df_left string, name_df_right string, slug string, accept string,
    replacement_name string, replacement_slug string"""
)

PAGE_CONTENT = _schema(
    """person_id string, person_id_ext string, person_name string, appointment_id_ext string,
    post_id_ext string, post_name string, post_name_clean string, post_rank string,
    is_on_leave boolean, is_acting boolean, leave_reason string, organisation_id_ext string,
    organisation_name string, organisation_name_clean string, organisation_short_name string,
    organisation_short_name_clean string, appointment_start_date date, appointment_end_date date"""
)

WORKFLOW = _schema(
    """appointment_id_core string, person_id string, person_name_core string, mp_peer string,
    post_name_core string, post_rank_core string, organisation_short_name_core string,
    cabinet_status string, is_on_leave_core boolean, is_acting_core boolean,
    leave_reason_core string, start_date_core date, end_date_core date,
    appointment_id_ext string, person_name_ext string, post_name_ext string,
    post_rank_ext string, organisation_short_name_ext string, is_on_leave_ext boolean,
    is_acting_ext boolean, leave_reason_ext string, start_date_ext date, end_date_ext date,
    organisation_short_name_match double, post_name_match double, start_date_match double,
    end_date_match double, date_match double, match_score double, reviewed boolean,
    match_accepted boolean, replace_post_name boolean, notes string"""
)


def cast_to_contract(df: DataFrame, contract: T.StructType) -> DataFrame:
    """The contract's columns, in its order and types. A missing column is an error."""
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in contract.fields])


def lower_ids(df: DataFrame, *columns: str) -> DataFrame:
    """Identifiers compare by value, not by letter case: lower them once, on the way in."""
    return df.withColumns({c: F.lower(F.col(c).cast("string")) for c in columns})


def by_value(df: DataFrame, *columns: str) -> DataFrame:
    """``lower_ids`` for those of the columns that are strings; numbers stay numbers."""
    return lower_ids(df, *(c for c in columns if isinstance(df.schema[c].dataType, T.StringType)))
