import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rollbook.functions.similarity import indel_ratio, indel_ratios, title_similarity, without_the


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def ratio(a, b):
    return 100.0 if not a and not b else 200.0 * lcs(a, b) / (len(a) + len(b))


def test_against_the_textbook_recurrence_over_lane_boundaries():
    rnd = random.Random(3)

    def text(size):
        return "".join(rnd.choice("abcd é😀漢") for _ in range(rnd.randint(0, size)))

    left = [text(n) for n in (4, 20, 64, 66, 150) for _ in range(60)] + ["a" * 64, "", "x", "a" * 65]
    right = [text(n) for n in (20, 64, 70, 4, 150) for _ in range(60)] + ["a" * 64, "", "", "a" * 64]
    got = indel_ratios(pa.array(left), pa.array(right))
    assert np.allclose(got, [ratio(a, b) for a, b in zip(left, right)])


def test_long_strings_over_word_boundaries():
    rnd = random.Random(4)
    sizes = [63, 64, 65, 127, 128, 129, 191, 192, 193, 320, 500, 700]
    left = ["".join(rnd.choice("ab é") for _ in range(n)) for n in sizes for _ in range(4)] + ["a" * 300, "a" * 192, "ab" * 200]
    right = ["".join(rnd.choice("ab é") for _ in range(rnd.choice(sizes))) for _ in left[:-3]] + ["a" * 300, "a" * 193, "ba" * 200]
    # an edited copy: long carries run through its words
    left += left[:20]
    right += [t[:70] + "x" + t[75:] for t in left[:20]]
    assert np.allclose(indel_ratios(pa.array(left), pa.array(right)), [ratio(a, b) for a, b in zip(left, right)])


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=90), st.text(max_size=90))
def test_symmetric_bounded_and_100_only_for_equal_strings(a, b):
    there = indel_ratios(pa.array([a], pa.string()), pa.array([b]))[0]
    back = indel_ratios(pa.array([b]), pa.array([a], pa.string()))[0]
    assert there == back and 0 <= there <= 100
    assert (there == 100) == (a == b)
    assert abs(there - ratio(a, b)) < 1e-9


def test_nulls_and_empty_strings_in_spark(spark):
    rows = [("abc", "abd"), (None, "a"), ("a", None), ("", ""), ("", "a"), (None, None)]
    df = spark.createDataFrame(rows, "a string, b string")
    got = [r.r for r in df.select(indel_ratio(F.col("a"), F.col("b")).alias("r")).collect()]
    assert got[1:3] == [None, None] and got[5] is None
    assert got[0] == pytest.approx(100 * 4 / 6) and got[3] == 100 and got[4] == 0


def test_title_similarity_takes_the_better_form(spark):
    rows = [
        ("Minister for the Army", "Minister for Army"),
        ("Minister for THE Army", "minister"),
        ("Secretary", "Secretary"),
        (None, "x"),
    ]
    df = spark.createDataFrame(rows, "a string, b string")
    a, b = F.col("a"), F.col("b")
    got = [r.s for r in df.select(title_similarity(a, b, without_the(a), without_the(b)).alias("s")).collect()]
    assert got[0] == 1 and got[2] == 1 and got[3] is None
    want = max(ratio(*rows[1]), ratio("Minister for Army", "minister")) / 100
    assert got[1] == pytest.approx(want)
