import random

import numpy as np
import pytest

from rollbook.operators import blocking, fuzzy
from rollbook.operators.grid import nearest_in_cell
from rollbook.operators.fuzzy import fuzzy_merge, nearest_names
from rollbook.operators.ranking import rank_within
from rollbook.plans.people import match_people
from tests.test_similarity import ratio
from pyspark.sql import functions as F


def brute_force(lefts, rights, limit, cutoff=0.0):
    out = set()
    for a in set(lefts):
        scored = sorted(((-round(ratio(a, b), 9), b) for b in set(rights)))[:limit]
        out |= {(a, b, -s) for s, b in scored if -s >= cutoff}
    return out


def names(rnd, count, alphabet, low, high):
    return ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(low, high))) for _ in range(count)]


def frames(spark, lefts, rights):
    return (
        spark.createDataFrame([(n,) for n in lefts], "name string"),
        spark.createDataFrame([(n,) for n in rights], "name string"),
    )


CASES = {
    # few letters: every gram is in a large share of the names
    "hot grams": lambda r: (names(r, 40, "ab", 0, 9), names(r, 60, "abc", 0, 9)),
    # nothing in common: similarity 0 must still be matched
    "disjoint": lambda r: (names(r, 8, "xyz", 1, 6), names(r, 12, "klm", 1, 6)),
    "words": lambda r: (
        [f"{a} {b}{i}" for i, (a, b) in enumerate([("red", "widget"), ("blue", "bolt"), ("small", "gear")] * 12)],
        [f"{a} {b}{i}" for i, (a, b) in enumerate([("red", "midget"), ("blau", "bolt"), ("smal", "gears")] * 15)],
    ),
    "unicode": lambda r: (names(r, 30, "é漢😀ab ", 0, 12), names(r, 50, "é漢😀ab ", 0, 12)),
    "copies": lambda r: (["Anna Lee"] * 30 + ["Ana Lee", "Bob"], ["Anna Lee"] * 40 + ["Anna Lea", "Rob", "Bo"]),
}


@pytest.mark.parametrize(
    "case,limit,cutoff",
    [(case, 1, 0.0) for case in CASES]
    + [("hot grams", 3, 0.0), ("copies", 3, 0.0), ("disjoint", 3, 0.0), ("words", 1, 72.0), ("hot grams", 1, 60.0)],
)
def test_equals_brute_force(spark, case, limit, cutoff):
    lefts, rights = CASES[case](random.Random(5))
    left, right = frames(spark, lefts, rights)
    found = nearest_names(left, right, "name", "name", limit, cutoff, probe_rows=5, pair_budget=50)
    got = {(r.left_name, r.right_name, round(r.score, 9)) for r in found.collect()}
    assert got == brute_force(lefts, rights, limit, cutoff)


@pytest.mark.parametrize("case,limit,cutoff", [(case, 1, 0.0) for case in CASES] + [("copies", 3, 0.0), ("unicode", 3, 0.0), ("disjoint", 3, 0.0), ("hot grams", 2, 60.0)])
def test_grid_of_small_blocks_and_gram_index_are_both_exact(spark, case, limit, cutoff):
    lefts, rights = CASES[case](random.Random(6))
    left, right = frames(spark, lefts, rights)
    wanted = brute_force(lefts, rights, limit, cutoff)
    for options in ({"blocks": (7, 11)}, {"grid_pairs": 0, "probe_rows": 5, "pair_budget": 50}):
        found = nearest_names(left, right, "name", "name", limit, cutoff, **options)
        assert {(r.left_name, r.right_name, round(r.score, 9)) for r in found.collect()} == wanted


@pytest.mark.parametrize("limit,cutoff", [(1, 0.0), (3, 0.0), (2, 55.0)])
def test_cell_with_and_without_keys(limit, cutoff):
    rnd = random.Random(8)
    lefts, rights = (sorted(set(names(rnd, count, "abcé漢 ", 0, 90))) + [""] for count in (50, 70))
    lefts, rights = list(dict.fromkeys(lefts)), list(dict.fromkeys(rights))
    keys = tuple(np.array([[rnd.randrange(9) for _ in range(3)] for _ in side]) for side in (lefts, rights))
    for held in (None, keys):
        wanted = set()
        for i, x in enumerate(lefts):
            scored = sorted((-ratio(x, y), y, j) for j, y in enumerate(rights) if held is None or (keys[0][i] == keys[1][j]).any())
            wanted |= {(i, j, round(-s, 9)) for s, _, j in scored[:limit] if -s > 0 and -s >= cutoff}
        a, b, score = nearest_in_cell(lefts, rights, limit, cutoff, held)
        assert {(i, j, round(s, 9)) for i, j, s in zip(a.tolist(), b.tolist(), score.tolist())} == wanted


def test_work_on_names_that_share_grams_is_bounded(spark, monkeypatch):
    """Names of few words and a number: no join of grams, and no join of wide bands, whose rows outnumber the pairs of names."""
    monkeypatch.setattr(fuzzy, "_by_grams", None)
    monkeypatch.setattr(blocking, "spread_join", None)
    words = [f"{a} {b}" for a in ("old", "cold", "large", "hot") for b in ("ring", "bolt", "gear")]
    lefts, rights = [f"{words[i % 12]} {i}" for i in range(300)], [f"{words[i * 7 % 12]} {i}" for i in range(0, 90, 3)]
    left, right = frames(spark, lefts, rights)
    wanted = brute_force(lefts, rights, 1)
    assert {(r.left_name, r.right_name, round(r.score, 9)) for r in nearest_names(left, right, "name", "name").collect()} == wanted
    found = blocking.blocked_names(left, right, "name", "name", bands=96, rows=1).collect()
    keyed = {"left": lefts, "right": rights}
    held = {k: {r[0]: r[1] for r in df.select("name", blocking.band_keys(F.col("name"), bands=96, rows=1)).collect()} for k, df in (("left", left), ("right", right))}
    sharing = {a: [b for b in keyed["right"] if any(x == y for x, y in zip(held["left"][a], held["right"][b]))] for a in keyed["left"]}
    best = {a: min((-ratio(a, b), b) for b in bs) for a, bs in sharing.items() if bs}
    assert {(r.left_name, r.right_name, round(r.score, 9)) for r in found} == {(a, b, round(-s, 9)) for a, (s, b) in best.items()}


def test_every_left_row_gets_a_match_and_ranks_within_the_person(spark):
    people = spark.createDataFrame([(1, "Ann Lee"), (1, "Ann Leigh"), (2, "Bob"), (3, "Qqq")], "id int, name string")
    listed = spark.createDataFrame(
        [(10, "The Rt Hon Ann Lee MP", "ann-lee"), (11, "Rob", "rob"), (9, "Rob", "rob-2")], "id int, name string, slug string"
    )
    rows = {(r.df_left_id, r.name_df_left): r for r in match_people(people, listed).collect()}
    assert len(rows) == 4
    assert rows[1, "Ann Lee"].match_score == 100 and rows[1, "Ann Lee"].duplicate_flag_df_left == 1
    assert rows[1, "Ann Leigh"].duplicate_flag_df_left == 2
    # a name held by two listed rows stands for the smaller id
    assert rows[2, "Bob"].df_right_id == 9 and rows[2, "Bob"].slug == "rob-2"


def test_fuzzy_merge_lists_all_namesakes(spark):
    left = spark.createDataFrame([(1, "John Smith"), (2, "John Smith")], "id int, name string")
    right = spark.createDataFrame([(10, "John Smith"), (11, "John Smith"), (12, "Jane Doe"), (13, "John Smith")], "id int, name string")
    for limit, expected in ((1, [10]), (2, [10, 11]), (3, [10, 11, 13]), (4, [10, 11, 12, 13])):
        rows = fuzzy_merge(left, right, "id", "id", limit=limit).collect()
        assert sorted((r.df_left_id, r.df_right_id) for r in rows) == [(i, j) for i in (1, 2) for j in expected]


def test_fuzzy_merge_keeps_copies_of_left_rows(spark):
    left = spark.createDataFrame([(i, "same") for i in range(20)], "id int, name string")
    right = spark.createDataFrame([(1, "sane"), (2, "other")], "id int, name string")
    rows = fuzzy_merge(left, right, "id", "id").collect()
    assert sorted(r.df_left_id for r in rows) == list(range(20)) and {r.df_right_id for r in rows} == {1}


def test_ranks_of_a_hot_key_span_partitions(spark):
    rows = [("hot", i % 7, i) for i in range(400)] + [("cold", 1, 1), ("cold", 2, 2), (None, 5, 5)]
    df = spark.createDataFrame(rows, "k string, score int, id int").repartition(8)
    got = rank_within(df, ["k"], [F.desc("score"), F.asc("id")], "place").collect()
    for key in ("hot", "cold", None):
        mine = sorted((r for r in got if r.k == key), key=lambda r: (-r.score, r.id))
        assert [r.place for r in mine] == list(range(1, len(mine) + 1))
    assert len(got) == len(rows)
