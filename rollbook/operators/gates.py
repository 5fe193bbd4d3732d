"""Checks taken while a run's table is written, and a gate in front of its publication.

Metrics are observed: Spark aggregates them in the tasks that compute the rows, in
the same pass. Uniqueness cannot be aggregated that way without gathering values,
so it is checked on the written rows, of which it reads one column.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable
from dataclasses import dataclass, field

from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollbook.operators.quality import duplicates
from rollbook.session import land, scratch
from rollbook.sources.tables import write_snapshot


class Refused(Exception):
    """A run that did not pass its gate. ``failed`` names the checks, ``measures`` has all that was measured."""

    def __init__(self, failed: list[str], measures: dict[str, int]):
        super().__init__(f"not published: {', '.join(failed)}; measured {measures}")
        self.failed, self.measures = failed, measures


class Measures:
    """Metrics of several points of one plan, known once the plan has been run.

    A point must be computed once by the run: a relation that the plan reads twice would be counted in
    one of its readings only.
    """

    def __init__(self) -> None:
        self._points: dict[str, tuple[Observation, DataFrame, list[Column]]] = {}

    def watch(self, point: str, df: DataFrame, **metrics: Column) -> DataFrame:
        """``df``, whose rows are counted as ``<point>.rows`` and aggregated as ``<point>.<metric>`` on their way."""
        measured = [F.count(F.lit(1)).alias("rows"), *(m.alias(n) for n, m in metrics.items())]
        self._points[point] = (Observation(point), df, measured)
        return df.observe(self._points[point][0], *measured)

    def read(self) -> dict[str, int]:
        known = {}
        for point, (seen, df, measured) in self._points.items():
            try:
                found = seen.get
            except Py4JError:
                # a run that turned out empty on the way is planned anew without this point
                found = df.agg(*measured).first().asDict()
            known |= {f"{point}.{name}": value for name, value in found.items()}
        return known


def lacking_prefix(column: str, prefix: str) -> Column:
    """Aggregate: values without the prefix."""
    return F.count_if(~F.col(column).startswith(prefix))


def longest(column: str) -> Column:
    """Aggregate: length of the longest value."""
    return F.max(F.length(column))


@dataclass
class Gate:
    """What must hold of a run: conditions on its measures, and columns whose values do not repeat."""

    conditions: dict[str, Callable[[dict[str, int]], bool]] = field(default_factory=dict)
    unique: tuple[str, ...] = ()


def publish(
    df: DataFrame, path: str, run: str | datetime.date, gate: Gate, measures: Measures | None = None,
    contract: T.StructType | None = None, partition: str = "run_date",
) -> dict[str, int]:
    """Write a run, check it, and only then put it in its place under ``path``; returns what was measured.

    The rows are computed once, into the shared folder, with ``measures`` taken on the way. A run that fails a
    check raises ``Refused`` and leaves what ``path`` had as it was. The first copy is removed either way.
    """
    measures = measures or Measures()
    with scratch(df.sparkSession):
        written = land(measures.watch("run", df), "run")
        known = measures.read()
        for column in gate.unique:
            known[f"run.repeated_{column}"] = duplicates(written.select(column).filter(F.col(column).isNotNull()), [column]).count()
        failed = [name for name, holds in gate.conditions.items() if not holds(known)]
        failed += [f"unique {c}" for c in gate.unique if known[f"run.repeated_{c}"]]
        if failed:
            raise Refused(failed, known)
        write_snapshot(written, path, run, contract, partition)
    return known
