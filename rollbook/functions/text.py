"""Small string expressions shared by the normalisers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Unicode white space plus the four separators U+001C..U+001F
_BLANK = r"[\s\x1c-\x1f]"


def strip(text: Column) -> Column:
    """Remove white space of any kind from both ends."""
    return F.regexp_replace(text, rf"(?U)^{_BLANK}+|{_BLANK}+\z", "")


def strip_all(df: DataFrame) -> DataFrame:
    """Strip every string column."""
    return df.select(
        *[
            strip(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that it names several times and that is worked out once a row."""
    return F.transform(F.array(value), body)[0]


def has(text: Column, part: str) -> Column:
    """Contains, with null as no."""
    return F.coalesce(text.contains(part), F.lit(False))


def without(text: Column, part: str, put: str = "") -> Column:
    return F.replace(text, F.lit(part), F.lit(put))


def before(text: Column, mark: str) -> Column:
    """Text up to the first ``mark``; all of it if there is none."""
    return F.substring_index(text, mark, 1)


def after(text: Column, mark: str) -> Column:
    """Text behind the first ``mark``; null if there is none."""
    at = F.instr(text, mark)
    return F.when(at > 0, F.substr(text, at + F.lit(len(mark))))


def bracketed(text: Column) -> Column:
    """Text between the first "(" and the next ")"; null without a "("."""
    return before(after(text, "("), ")")


def escape_quotes(text: Column) -> Column:
    return F.replace(text, F.lit("'"), F.lit("''"))
