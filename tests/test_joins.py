import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from rollbook.operators.skew import spread_join
from rollbook.operators.validity import interval_contained, overlaps, point_in_validity


def rows_of(df):
    return sorted(map(str, map(tuple, df.collect())))


@pytest.mark.parametrize("budget", [1, 10, 1000, 10**9])
def test_spread_join_gives_all_pairs_once(spark, budget):
    # one key holds a third of the rows of both sides, and copies of rows
    left = spark.createDataFrame([(1, i % 20) for i in range(40)] + [(k, k) for k in range(2, 60)], "k int, a int")
    right = spark.createDataFrame([(1, i) for i in range(35)] + [(k, k) for k in range(30, 70)], "k int, b int")
    assert rows_of(spread_join(left, right, ["k"], budget)) == rows_of(left.join(right, "k").select("k", "a", "b"))


def test_partitions_follow_the_pairs(spark):
    left = spark.createDataFrame([(1, i) for i in range(100)], "k int, a int")
    right = spark.createDataFrame([(1, i) for i in range(100)], "k int, b int")
    joined = spread_join(left, right, ["k"], pair_budget=500)
    assert joined.rdd.getNumPartitions() == 20 and joined.count() == 10_000
    assert max(joined.rdd.glom().map(len).collect()) < 4_000


def day(n):
    return None if n is None else dt.date(1990, 1, 1) + dt.timedelta(days=n)


def spans(rnd, count, keys):
    out = []
    for i in range(count):
        start = rnd.choice([None, rnd.randint(-40000, 8000), rnd.randint(0, 8000)])
        end = None if rnd.random() < 0.3 else (start or 0) + rnd.randint(0, 3000)
        out.append((rnd.choice(keys), i, day(start), day(end)))
    return out


@pytest.mark.parametrize("guard", [True, False])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_keys_change_nothing(spark, guard, how):
    rnd = random.Random(9)
    left = spark.createDataFrame(
        [(rnd.choice([1, 1, 2, 3, 4, None]), i, day(rnd.choice([None, rnd.randint(-50000, 60000), rnd.randint(0, 9000)]))) for i in range(120)],
        "lk int, lid int, at date",
    )
    right = spark.createDataFrame(spans(rnd, 90, [1, 1, 1, 2, 3]), "rk int, rid int, since date, until date")
    since = F.coalesce("since", F.lit(dt.date(1900, 1, 1))) if guard else F.col("since")
    on = (F.col("lk") == F.col("rk")) & (F.col("at") >= since) & (F.col("at") < F.coalesce("until", F.lit(dt.date(9999, 12, 31))))
    plain = rows_of(left.join(right, on, how))
    for hot in (0, 20, 10**6):
        got = point_in_validity(left, right, "lk", "rk", "at", "since", "until", guard, how, pair_budget=hot)
        assert rows_of(got) == plain


def test_containment_has_closed_ends(spark):
    left = spark.createDataFrame([(1, day(0), day(10)), (1, day(0), None), (1, day(5), day(11)), (2, day(0), day(1))], "k int, s date, e date")
    right = spark.createDataFrame([(1, day(0), day(10)), (1, None, None)], "rk int, rs date, re date")
    got = interval_contained(left, right, [("k", "rk")], "s", "e", "rs", "re").select("k", "s", "rs", "re").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(
        str(r) for r in [(1, day(0), day(0), day(10)), (1, day(0), None, None), (1, day(0), None, None), (1, day(5), None, None), (2, day(0), None, None)]
    )


def test_overlaps_equal_lead_over_the_key(spark):
    rnd = random.Random(4)
    rows = [(rnd.choice([1, 1, 2]), i, day(rnd.randint(0, 60)), rnd.choice([None, day(rnd.randint(0, 90))])) for i in range(150)]
    df = spark.createDataFrame(rows, "k int, id int, s date, e date")
    ahead = Window.partitionBy("k").orderBy("s", "id")
    plain = df.withColumn("next_start", F.lead("s").over(ahead)).filter("next_start < coalesce(e, date '9999-12-31')")
    assert rows_of(overlaps(df, "k", "id", "s", "e")) == rows_of(plain)
