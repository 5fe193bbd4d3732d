"""Nested JSON pages: land them, attach their owners, flatten them to rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollbook.functions.text import bind


def prune(schema: T.StructType, paths: Sequence[str]) -> T.StructType:
    """Only the fields that lie on one of the dotted paths; the rest is never parsed."""

    def keep(data_type: T.DataType, wanted: list[list[str]]) -> T.DataType:
        if any(not path for path in wanted):
            return data_type
        if isinstance(data_type, T.ArrayType):
            return T.ArrayType(keep(data_type.elementType, wanted), data_type.containsNull)
        if isinstance(data_type, T.StructType):
            fields = []
            for field in data_type.fields:
                below = [path[1:] for path in wanted if path[0] == field.name]
                if below:
                    fields.append(T.StructField(field.name, keep(field.dataType, below), field.nullable))
            return T.StructType(fields)
        return data_type

    return keep(schema, [path.split(".") for path in paths])


def land_payloads(df: DataFrame, path: str) -> DataFrame:
    """Write the raw pages as they came and go on from the written copy."""
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def attach_owner(lookup: DataFrame, raw: DataFrame, key: str, owner: str, owner_name: str) -> DataFrame:
    """(owner, payload) for each row of the lookup whose page was landed."""
    return lookup.select(key, F.col(owner).alias(owner_name)).join(raw, key)


_CORRUPT = "_corrupt"


def _read_page(payload: Column, schema: T.StructType) -> Column:
    """The page under the schema, and under ``_corrupt`` its text if it does not read as one."""
    held = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    return F.from_json(payload, held, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})


def parse_payload(
    df: DataFrame, schema: T.StructType, payload: str = "payload", paths: Sequence[str] | None = None
) -> DataFrame:
    """Replace the JSON column by the page's top-level fields. Pages that do not read are left out: see ``unreadable``."""
    wanted = schema if paths is None else prune(schema, paths)
    others = [c for c in df.columns if c != payload]
    read = df.select(*others, F.col(payload).alias("_payload"), _read_page(F.col(payload), wanted).alias("_page")).filter(_reads())
    return read.select(*others, *[F.col(f"_page.`{f.name}`").alias(f.name) for f in wanted.fields])


def _reads() -> Column:
    # a missing payload is a page without content, and gives its row of nulls
    return F.col("_payload").isNull() | (F.col("_page").isNotNull() & F.col(f"_page.{_CORRUPT}").isNull())


def unreadable(df: DataFrame, schema: T.StructType, payload: str = "payload", paths: Sequence[str] | None = None) -> DataFrame:
    """The pages that ``parse_payload`` leaves out, with a ``reason``.

    ``broken``: the payload is no JSON. ``drifted``: it is, but a field has another type than asked for.
    """
    wanted = schema if paths is None else prune(schema, paths)
    read = df.select("*", F.col(payload).alias("_payload"), _read_page(F.col(payload), wanted).alias("_page")).filter(~_reads())
    is_json = F.try_parse_json(payload).isNotNull()
    return read.select(*df.columns, F.when(is_json, "drifted").otherwise("broken").alias("reason"))


def _paths_of(data_type: T.DataType, prefix: str = "") -> list[str]:
    """Dotted paths of all fields of a schema; arrays add nothing to a path."""
    if isinstance(data_type, T.ArrayType):
        return _paths_of(data_type.elementType, prefix)
    if not isinstance(data_type, T.StructType):
        return []
    return [path for f in data_type.fields for path in (prefix + f.name, *_paths_of(f.dataType, f"{prefix}{f.name}."))]


def _paths_seen(value: Column, data_type: T.DataType, prefix: str = "") -> Column:
    """Paths that a JSON text has, as far down as the schema goes: fields the schema does not name are seen, not entered."""
    if isinstance(data_type, T.ArrayType):
        elements = F.coalesce(F.from_json(value, "array<string>"), F.array().cast("array<string>"))
        return F.flatten(F.transform(elements, lambda e: _paths_seen(e, data_type.elementType, prefix)))
    if not isinstance(data_type, T.StructType):
        return F.array().cast("array<string>")

    def fields(entries: Column) -> Column:
        own = F.transform(F.map_keys(entries), lambda k: F.concat(F.lit(prefix), k))
        below = [_paths_seen(F.try_element_at(entries, F.lit(f.name)), f.dataType, f"{prefix}{f.name}.") for f in data_type.fields]
        return F.concat(own, *below)

    return F.coalesce(bind(F.from_json(value, "map<string,string>"), fields), F.array().cast("array<string>"))


def schema_drift(df: DataFrame, schema: T.StructType, payload: str = "payload") -> DataFrame:
    """(path, asked, pages): every field asked for or seen, and the number of pages that have it.

    A field that is asked for and in no page was dropped or renamed at the source; one that is not asked for
    is new there. Pages that are no JSON are not looked at.
    """
    seen = (
        df.filter(F.try_parse_json(payload).isNotNull())
        .select(F.explode(F.array_distinct(_paths_seen(F.col(payload), schema))).alias("path"))
        .groupBy("path").agg(F.count(F.lit(1)).alias("pages"))
    )
    asked = df.sparkSession.createDataFrame([(path, True) for path in _paths_of(schema)], "path string, asked boolean")
    return asked.join(seen, "path", "full").select("path", F.coalesce("asked", F.lit(False)).alias("asked"), F.coalesce("pages", F.lit(0)).alias("pages"))


def flatten(df: DataFrame) -> DataFrame:
    """Objects become dotted columns, arrays become rows.

    A null or empty array keeps its row, with nulls below it. Arrays beside one
    another multiply, so prune the schema to the wanted paths first.
    """
    while True:
        opened, array = [], None
        for field in df.schema.fields:
            column = F.col(f"`{field.name}`")
            if isinstance(field.dataType, T.StructType):
                opened += [
                    column.getField(child.name).alias(f"{field.name}.{child.name}") for child in field.dataType.fields
                ]
            elif isinstance(field.dataType, T.ArrayType) and array is None:
                array = field.name  # one generator per projection
                opened.append(F.explode_outer(column).alias(field.name))
            else:
                opened.append(column)
        nested = any(isinstance(f.dataType, (T.StructType, T.ArrayType)) for f in df.schema.fields)
        if not nested:
            return df
        df = df.select(*opened)
