"""Optional blocking in front of the fuzzy merge, and its measured recall.

Names meet only if they agree in all minimum hashes of one band over their grams
(MinHash with bands: Broder 1997). Two names whose grams overlap by a Jaccard share
of j meet with probability ``1 - (1 - j^rows)^bands``, so some best matches are
lost: ``blocking_recall`` says how many, against the exact merge on a hashed sample of
the names. Nothing uses blocking unless it is asked for.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.functions.bands import band_columns, band_numbers
from rollbook.functions.similarity import indel_ratio
from rollbook.functions.text import bind
from rollbook.operators.fuzzy import best_matches, nearest_names
from rollbook.operators.grid import nearest_by_grid
from rollbook.operators.skew import PAIR_BUDGET, key_sizes, spread_join
from rollbook.session import land

GRAM, BANDS, ROWS = 2, 24, 2
_SAMPLE_SPACE = 1 << 20


def band_keys(name: Column, gram: int = GRAM, bands: int = BANDS, rows: int = ROWS) -> Column:
    """One key per band: a hash of the least hashes, under ``rows`` seeds, of the name's grams."""
    marked = F.concat(F.lit("\u0001" * (gram - 1)), name, F.lit("\u0002" * (gram - 1)))
    starts = F.sequence(F.lit(1), F.greatest(F.length(marked) - (gram - 1), F.lit(1)))
    grams = F.array_distinct(F.transform(starts, lambda i: F.substr(marked, i, F.lit(gram))))

    def keys(held: Column) -> Column:
        least = lambda seed: F.array_min(F.transform(held, lambda g: F.xxhash64(g, F.lit(seed))))
        return F.array(*(F.xxhash64(F.lit(b), *(least(b * rows + r) for r in range(rows))) for b in range(bands)))

    return bind(grams, keys)


def _band_sizes(names: DataFrame, called: str, gram: int, bands: int, rows: int, size: str) -> DataFrame:
    """(_band, size): names of each band, counted by batch before they are shuffled."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys in band_columns(batch.column(0).to_pylist(), gram, bands, rows):
                held, n = np.unique(keys, return_counts=True)
                yield pa.record_batch({"_band": held, "n": n})

    counted = names.select(called).mapInArrow(count, "_band long, n long")
    return counted.groupBy("_band").agg(F.sum("n").alias(size))


def _banded(names: DataFrame, called: str, gram: int, bands: int, rows: int) -> DataFrame:
    """(name, _band): every band of every name, once."""
    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys in band_columns(batch.column(0).to_pylist(), gram, bands, rows):
                yield pa.record_batch({called: batch.column(0).cast(pa.string()), "_band": keys})

    return land(names.select(called).mapInArrow(rows_of, f"{called} string, _band long"), "bands")


def blocked_names(
    left: DataFrame, right: DataFrame, left_name: str, right_name: str, limit: int = 1, score_cutoff: float = 0.0,
    gram: int = GRAM, bands: int = BANDS, rows: int = ROWS, pair_budget: int = PAIR_BUDGET,
) -> DataFrame:
    """``nearest_names`` among the names that share a band: (left_name, right_name, score).

    A left name that shares a band with no right name is missing; one whose best match shares none gets a lesser one.
    """
    def names(df: DataFrame, name: str, called: str) -> DataFrame:
        return land(df.select(F.col(name).alias(called)).filter(F.col(called).isNotNull()).distinct(), "block-names")

    lefts, rights = names(left, left_name, "left_name"), names(right, right_name, "right_name")
    sides = ((lefts, "left_name", "n"), (rights, "right_name", "m"))
    sizes = [_band_sizes(df, called, gram, bands, rows, size) for df, called, size in sides]
    work = sizes[0].join(sizes[1], "_band").agg(F.sum(F.col("n").cast("double") * F.col("m"))).first()[0] or 0.0
    n_lefts, n_rights = lefts.count(), rights.count()
    if work > n_lefts * n_rights:
        # bands so wide that their pairs, repeats included, are more than all pairs there are; the keys of a cell are worked out in it
        keyed = partial(band_numbers, gram=gram, bands=bands, rows=rows)
        return best_matches(nearest_by_grid(lefts, rights, n_lefts, n_rights, limit, score_cutoff, keyed=keyed), limit)
    banded = [_banded(df, called, gram, bands, rows) for df, called, _ in sides]
    pairs = spread_join(*banded, ["_band"], pair_budget, work=work).select("left_name", "right_name").distinct()
    scored = pairs.select("left_name", "right_name", indel_ratio(F.col("left_name"), F.col("right_name")).alias("score"))
    return best_matches(scored.filter(F.col("score") >= score_cutoff), limit)


def name_sample(names: DataFrame, name: str, share: float) -> DataFrame:
    """The rows whose name hashes into the share: the same names in every run."""
    return names.filter(F.pmod(F.xxhash64(name, F.lit("sample")), F.lit(_SAMPLE_SPACE)) < int(share * _SAMPLE_SPACE))


def blocking_recall(
    left: DataFrame, right: DataFrame, left_name: str, right_name: str, share: float = 0.01, blocked: DataFrame | None = None,
    exact: DataFrame | None = None, **options
) -> DataFrame:
    """One row: ``names`` in the sample, how many ``found`` a match as good as the exact one, and the ``recall``.

    ``blocked``, ``exact``: what ``blocked_names`` and ``nearest_names`` gave for all the names, where that is at hand.
    """
    sample = name_sample(left, left_name, share)
    exact = name_sample(exact, "left_name", share) if exact is not None else nearest_names(sample, right, left_name, right_name)
    exact = exact.select("left_name", F.col("score").alias("best"))
    ours = blocked if blocked is not None else blocked_names(sample, right, left_name, right_name, **options)
    ours = ours.groupBy("left_name").agg(F.max("score").alias("reached"))
    good = F.count_if(F.coalesce(F.col("reached") >= F.col("best") - 1e-9, F.lit(False)))
    met = exact.join(ours, "left_name", "left").agg(F.count(F.lit(1)).alias("names"), good.alias("found"))
    return met.withColumn("recall", F.when(F.col("names") > 0, F.col("found") / F.col("names")))
