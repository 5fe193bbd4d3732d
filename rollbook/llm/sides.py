"""Join sides whose size is looked at."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows up to which a side of a few numbers a row is broadcast (some megabytes); beyond, Spark shuffles both sides.
FEW_ROWS = 500_000


def broadcast_if_few(side: DataFrame, rows: int = FEW_ROWS, weight: str | None = None) -> DataFrame:
    """``side``, cheap to read again, marked for broadcast if it has at most ``rows`` rows (or sum of ``weight``, an expression)."""
    size = side.count() if weight is None else side.agg(F.sum(F.expr(weight))).first()[0] or 0
    return F.broadcast(side) if size <= rows else side
