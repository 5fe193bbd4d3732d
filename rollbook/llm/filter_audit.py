"""What each of five quality filters removes in every order, and its Shapley share, by exact constrained least squares.

A document is reduced to the set of filters it fails. For every part of the corpus
the removals ``v(S)`` of all 32 coalitions S of filters are tabulated: ``v(S)`` is the
number of documents that fail at least one filter of S. Everything asked of an order
of the filters is a difference of such numbers: a step that puts filter i behind the
filters S removes ``v(S + i) - v(S)`` of the ``v(i)`` documents that fail it; those
that fail nothing else are ``v(all) - v(all - i)``.

The Shapley shares are the weights of the additive game nearest to v, that is the
minimum of ``sum k(S) (v(S) - sum of phi over S)^2`` over the proper coalitions with
the Shapley kernel ``k(S) = (m - 1) / (C(m, |S|) |S| (m - |S|))``, under
``sum phi = v(all)`` (efficiency). Its normal equations, with one multiplier for
the constraint, are solved in rationals, so the sums over all orders are whole
numbers without rounding.

Identical texts are found by their SHA-256, and counted per (text, part, labels)
before they meet; so a text that a third of all rows hold is a few hundred rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from itertools import permutations
from math import comb, factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

FILTERS = "ABCDE"
ALL = (1 << len(FILTERS)) - 1
REPEATED = 1 << FILTERS.index("E")

STEPS = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def own_failures(text: Column) -> Column:
    """Bits of the filters A to D that a text fails by itself; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, "[ \\t-\\r]+"), lambda w: w != "")
    counted = F.array(F.struct(F.size(words).cast("long").alias("n"), F.size(F.array_distinct(words)).cast("long").alias("kinds")))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long")
    by_words = F.transform(counted, lambda w: F.when(w["n"] < 50, 1).otherwise(0) + F.when(100 * w["kinds"] < 65 * w["n"], 2).otherwise(0))[0]
    return by_words + F.when(100 * capitals > 5 * F.length(text).cast("long"), 4).otherwise(0) + F.when(text.rlike("[#$%&*|]"), 8).otherwise(0)


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents counted by what they fail: ``part, mask, n, good, toxic``.

    ``docs`` needs ``doc_id``, ``text`` and ``source``, ``labels`` needs ``doc_id``, ``quality`` and
    ``toxic``; other columns are ignored. A null source is the empty part. A text repeats if a smaller doc_id
    has the same text, in whatever part; rows of one doc_id do not repeat each other, and a null doc_id
    neither repeats a text nor is repeated. Of several label rows for a document, one that says 1 is enough.
    """
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max((F.coalesce("quality", F.lit(0)) == 1)).alias("good"), F.max((F.coalesce("toxic", F.lit(0)) == 1)).alias("toxic"))
    rows = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("digest"), own_failures(F.col("text")).alias("mask"))
    kind = ["digest", "mask", "part", "good", "toxic"]
    known = rows.join(marks, "doc_id", "left").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})
    copies = known.groupBy("doc_id", *kind).agg(F.count("*").alias("rows")).groupBy(*kind).agg(
        F.sum("rows").alias("n"),
        F.sum(F.when(F.col("doc_id").isNotNull(), F.col("rows")).otherwise(0)).alias("with_id"),
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "rows"))).alias("first"),
    )
    least = F.min("first.doc_id").over(W.partitionBy("digest"))
    repeats = F.col("with_id") - F.when(F.col("first.doc_id") == least, F.col("first.rows")).otherwise(0)
    split = copies.withColumn("repeats", repeats).select(
        "part", "good", "toxic", F.inline(F.array(F.struct("mask", (F.col("n") - F.col("repeats")).alias("n")), F.struct(F.col("mask").bitwiseOR(F.lit(REPEATED)).alias("mask"), F.col("repeats").alias("n"))))
    )
    return split.where("n > 0").groupBy("part", "mask").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"), F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"))


def coalitions(counted: DataFrame) -> DataFrame:
    """Per part its documents and the removals of all 32 coalitions: of all, good and toxic documents."""
    removals = [F.array(*(F.sum(F.when(F.col("mask").bitwiseAND(F.lit(s)) != 0, F.col(c)).otherwise(0)) for s in range(ALL + 1))).alias(f"v_{c}") for c in ("n", "good", "toxic")]
    return counted.groupBy("part").agg(F.sum("n").alias("documents"), *removals)


def solve(matrix: list[list[Fraction]], right: list[Fraction]) -> list[Fraction]:
    """Solution of a regular system of linear equations, by elimination in rationals."""
    rows = [[*row, b] for row, b in zip(matrix, right)]
    for k in range(len(rows)):
        pivot = next(i for i in range(k, len(rows)) if rows[i][k])
        rows[k], rows[pivot] = rows[pivot], rows[k]
        rows[k] = [x / rows[k][k] for x in rows[k]]
        for i, row in enumerate(rows):
            if i != k and row[k]:
                rows[i] = [x - row[k] * y for x, y in zip(row, rows[k])]
    return [row[-1] for row in rows]


def shapley_shares(removals: list[int]) -> list[Fraction]:
    """Shapley value of each player of the game ``removals``, indexed by the coalition's bits."""
    m = (len(removals) - 1).bit_length()
    proper = range(1, len(removals) - 1)
    kernel = {s: Fraction(m - 1, comb(m, s.bit_count()) * s.bit_count() * (m - s.bit_count())) for s in proper}
    normal = [[sum((kernel[s] for s in proper if s >> i & s >> j & 1), Fraction(0)) for j in range(m)] + [Fraction(1)] for i in range(m)]
    right = [sum((kernel[s] * removals[s] for s in proper if s >> i & 1), Fraction(0)) for i in range(m)]
    return solve([*normal, [Fraction(1)] * m + [Fraction(0)]], [*right, Fraction(removals[-1])])[:m]


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [field.split()[0] for field in STEPS.split(", ")]
    for batch in batches:
        for part in batch.to_pylist():
            n, good, toxic = part["v_n"], part["v_good"], part["v_toxic"]
            over_orders = [share * factorial(len(FILTERS)) for share in shapley_shares(n)]
            rows = []
            for order in permutations(range(len(FILTERS))):
                before = 0
                for step, i in enumerate(order, 1):
                    after = before | 1 << i
                    removed = n[after] - n[before]
                    rows.append((
                        part["part"], "".join(FILTERS[j] for j in order), step, part["documents"] - n[after], removed, n[1 << i] - removed,
                        n[ALL] - n[ALL & ~(1 << i)], good[after] - good[before], toxic[after] - toxic[before], int(over_orders[i]),
                    ))
                    before = after
            columns = [pa.array(c, pa.string() if k < 2 else pa.int32() if k == 2 else pa.int64()) for k, c in enumerate(zip(*rows))]
            yield pa.RecordBatch.from_arrays(columns, names=names)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every step of every order of the filters, per part: ``STEPS``; inputs as in ``failures``. No documents, no rows.

    ``shapley`` is the filter's removals summed over all 120 orders.
    """
    return coalitions(failures(docs, labels)).mapInArrow(_steps, STEPS)
