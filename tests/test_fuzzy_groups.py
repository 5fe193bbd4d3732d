"""Groups of like names in a cell, and band keys worked out in it."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollbook.functions.bands import band_columns, band_numbers, text_hash
from rollbook.operators import blocking, fuzzy, grid
from rollbook.operators.fuzzy import nearest_names
from tests.test_fuzzy import brute_force, frames, names
from tests.test_similarity import ratio


def numbered(rnd, count):
    words = [f"{a} {b}" for a in ("old", "cold", "large", "hot", "blue", "small") for b in ("ring", "bolt", "gear", "plate", "widget")]
    return list(dict.fromkeys(f"{rnd.choice(words)} {rnd.randrange(10**6)}" for _ in range(count)))


def test_unlike_groups_are_ruled_out_as_wholes(monkeypatch):
    """Few of the pairs get a bound of their own, and fewer a score; nothing is lost."""
    rnd = random.Random(3)
    lefts, rights = numbered(rnd, 1500), numbered(rnd, 3000)
    scored = []
    ratios = grid._Scorer.ratios
    monkeypatch.setattr(grid._Scorer, "ratios", lambda self, a, b: scored.append(len(a)) or ratios(self, a, b))
    monkeypatch.setattr(grid, "_LEFT_GROUP", 100)
    monkeypatch.setattr(grid, "_RIGHT_GROUP", 30)
    a, b, score = nearest = grid.nearest_in_cell(lefts, rights, 1, 0.0)
    assert sum(scored) < len(lefts) * len(rights) / 20
    assert sorted(a.tolist()) == list(range(len(lefts)))
    for i in range(0, len(lefts), 75):
        best = min((-ratio(lefts[i], y), y) for y in rights)
        at = nearest[0].tolist().index(i)
        assert (rights[b[at]], round(score[at], 9)) == (best[1], -round(best[0], 9))


@pytest.mark.parametrize("left_group,right_group,pairs", [(1, 1, 1), (7, 3, 50), (2048, 256, 1 << 15)])
@pytest.mark.parametrize("limit,cutoff", [(1, 0.0), (3, 0.0), (2, 55.0)])
def test_cell_of_groups_of_any_size(monkeypatch, left_group, right_group, pairs, limit, cutoff):
    rnd = random.Random(limit)
    lefts, rights = (list(dict.fromkeys(["", *names(rnd, count, "aab漢 😀", 0, 12), "b" * 70])) for count in (25, 40))
    for name, value in (("_LEFT_GROUP", left_group), ("_RIGHT_GROUP", right_group), ("_PAIRS", pairs)):
        monkeypatch.setattr(grid, name, value)
    keys = tuple(np.array([[rnd.randrange(5) for _ in range(2)] for _ in side]) for side in (lefts, rights))
    for held in (None, keys):
        wanted = set()
        for i, x in enumerate(lefts):
            scored = sorted((-round(ratio(x, y), 9), y, j) for j, y in enumerate(rights) if held is None or (keys[0][i] == keys[1][j]).any())
            wanted |= {(i, j, -s) for s, _, j in scored[:limit] if -s > 0 and -s >= cutoff}
        got = grid.nearest_in_cell(lefts, rights, limit, cutoff, held)
        assert {(i, j, round(s, 9)) for i, j, s in zip(*(x.tolist() for x in got))} == wanted


def test_names_of_the_largest_tables_meet_in_blocks():
    """5.4 million names and 360,000 others: a row on disk for every gram is more than the tables."""
    assert 5_400_000 * 360_000 <= fuzzy.GRID_PAIRS


@pytest.mark.parametrize("gram,bands,rows", [(2, 4, 1), (1, 3, 2), (3, 2, 3), (40, 2, 2)])
def test_band_columns_are_the_band_keys(spark, gram, bands, rows):
    held = ["", "a", "é漢😀 name", "x" * 70, "aaaa", "漢" * 20, "b" * 31, "bolt 12"]
    df = spark.createDataFrame(list(enumerate(held)), "id int, name string").orderBy("id")
    wanted = [r[0] for r in df.select(blocking.band_keys(F.col("name"), gram, bands, rows)).collect()]
    assert [list(k) for k in zip(*(column.tolist() for column in band_columns(held, gram, bands, rows)))] == wanted
    left, right = band_numbers(held[:5], held[5:], gram, bands, rows)
    assert [[x == y for x, y in zip(a, b)] for a in wanted[:5] for b in wanted[5:]] == [(a == b).tolist() for a in left for b in right]
    assert list(band_columns([], gram, bands, rows))[0].tolist() == []
    assert text_hash("x" * 45) == spark.range(1).select(F.xxhash64(F.lit("x" * 45))).first()[0] % (1 << 64)


def test_wide_bands_are_neither_written_nor_shuffled(spark, monkeypatch):
    """The keys of a name, forty times its own size, are worked out where they are compared; the exact matches are not sought twice."""
    rnd = random.Random(4)
    lefts, rights = numbered(rnd, 120), numbered(rnd, 60)
    left, right = frames(spark, lefts, rights)
    landed = []
    land = blocking.land
    monkeypatch.setattr(blocking, "land", lambda df, name: landed.append(df.schema.simpleString()) or land(df, name))
    found = blocking.blocked_names(left, right, "name", "name", bands=96, rows=1)
    assert landed == ["struct<left_name:string>", "struct<right_name:string>"]
    exact = nearest_names(left, right, "name", "name")
    wanted = blocking.blocking_recall(left, right, "name", "name", share=0.5, blocked=found).first()
    monkeypatch.setattr(blocking, "nearest_names", None)
    assert blocking.blocking_recall(left, right, "name", "name", share=0.5, blocked=found, exact=exact).first() == wanted


def test_narrow_bands_still_join(spark):
    lefts, rights = ["Ann Lee", "Bob Stone", "Zed"], ["Ann Lea", "Bob Stone", "Qqq"]
    left, right = frames(spark, lefts, rights)
    found = {(r.left_name, r.right_name) for r in blocking.blocked_names(left, right, "name", "name", bands=4, rows=3).collect()}
    keys = {n: blocking_keys for n, blocking_keys in zip(lefts + rights, zip(*(c.tolist() for c in band_columns(lefts + rights, 2, 4, 3))))}
    meeting = {a: [b for b in rights if set(keys[a]) & set(keys[b])] for a in lefts}
    assert found == {(a, min((-ratio(a, b), b) for b in bs)[1]) for a, bs in meeting.items() if bs}
    assert ("Bob Stone", "Bob Stone") in found and brute_force(lefts, rights, 1)
