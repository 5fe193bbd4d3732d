"""Plans that follow a check of their data: validity chain, overlap, titles scored once, gates, buckets, blocking."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from driver_keys.queries import AS_OF, MIN_START, QUERIES
from driver_keys.views import Frames
from rollbook.functions.names import post_topic
from rollbook.operators import blocking, changes, gates, quality
from rollbook.operators.fuzzy import nearest_names
from rollbook.operators.matching import person_sizes, score_candidates, scored_titles, titles_repeat
from rollbook.operators.validity import any_overlap, keys_to_cut, point_in_validity
from rollbook.plans import appointments, pages, people
from rollbook.session import new_path
from rollbook.sources import payloads, tables

SF = "/root/testdata/sf0.001"


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def relations(df):
    plan = optimized(df)
    return plan.count("Relation [")


def rows_of(df):
    return sorted(map(str, map(tuple, df.collect())))


# validity chain


def test_chain_reads_its_facts_once(spark):
    joined = QUERIES["temporal_left_join"](spark, SF)
    once = QUERIES["temporal_left_join_unique"](spark, SF)
    assert relations(joined) <= 25
    # the spells of a seat do not overlap: their join is not planned, and repeats no row
    assert relations(once) < relations(joined) and "representation_id" not in optimized(once)


def test_hot_key_of_a_chain_is_cut_and_rows_stay(spark):
    f = Frames(spark, SF)
    parts = (f.v_appt, f.v_spell, f.v_person, f.v_repr, f.v_post, f.v_org, MIN_START, f.v_repr_spell)
    plain, cut = appointments.core_appointments(*parts), appointments.core_appointments(*parts, pair_budget=20)
    assert "_at_bucket" in cut._jdf.queryExecution().analyzed().toString() and "_at_bucket" not in plain._jdf.queryExecution().analyzed().toString()
    assert rows_of(cut) == rows_of(plain) and relations(cut) <= relations(plain) + 6


def test_keys_to_cut_are_found_by_one_landed_count(spark):
    left = spark.createDataFrame([(1, dt.date(1995, 3, 1))] * 30 + [(2, dt.date(2001, 5, 1))], "k int, at date")
    right = spark.createDataFrame([(1, i, dt.date(1990 + i, 1, 1), dt.date(1991 + i, 1, 1)) for i in range(10)] + [(2, 99, None, None)], "rk int, rid int, s date, e date")
    links = spark.createDataFrame([(1, 11), (2, 12)], "old int, new int")
    more = spark.createDataFrame([(11, i) for i in range(50)] + [(12, 0)], "x int, y int")
    first, second, none, few = keys_to_cut(left, "k", "at", [(right, "rk", None), (more, "x", links), (right.limit(1), "rk", None), (more.filter("x = 12"), "x", links)], pair_budget=299)
    assert few is None
    assert [r["_hot_key"] for r in first.collect()] == [1] and [r["_hot_key"] for r in second.collect()] == [11] and none is None
    got = point_in_validity(left, right, "k", "rk", "at", "s", "e", cut=first)
    assert rows_of(got) == rows_of(point_in_validity(left, right, "k", "rk", "at", "s", "e", cut=None)) and got.count() == 31


@pytest.mark.parametrize(
    ("spans", "expected"),
    [
        ([("a", 0, 10), ("a", 10, 20), ("b", 5, 15)], False), ([("a", 0, 10), ("a", 9, 20)], True), ([("a", 0, None), ("a", 400, 401)], True),
        ([("a", None, 10), ("a", 0, 10)], False), ([("a", 3, 3), ("a", 0, 10)], False), ([("a", 0, 5), ("a", 0, 5)], True), ([(None, 0, 5), (None, 0, 5)], False), ([], False),
    ],
)
def test_any_overlap(spark, spans, expected):
    day = lambda n: None if n is None else dt.date(2000, 1, 1) + dt.timedelta(days=n)
    df = spark.createDataFrame([(k, day(s), day(e)) for k, s, e in spans], "k string, s date, e date")
    assert any_overlap(df, "k", "s", "e") is expected


# titles scored once


def test_every_title_pair_is_scored_once(spark):
    f = Frames(spark, SF)
    core = appointments.core_appointments(f.v_appt, f.v_spell, f.v_person, f.v_repr, f.v_post, f.v_org, MIN_START)
    core = core.withColumnsRenamed({"post_name": "post_name_core"})
    ext = f.v_ext_appt.withColumnsRenamed({"post_name": "post_name_ext"})
    titles = scored_titles(core, ext, "_core", "_ext", person_sizes(core, ext, "_core", "_ext"))
    pairs = core.select("person_id", "post_name_core").join(ext.select("person_id", "post_name_ext"), "person_id")
    plan = titles._jdf.queryExecution().optimizedPlan().toString()
    # what the scorer is handed are the rows of the distinct table under it
    assert plan.index("ArrowEvalPython") < plan.index("Aggregate [_own_title") and plan.count("ArrowEvalPython") == 1
    distinct = pairs.select("post_name_core", "post_name_ext").distinct().count()
    assert titles.count() == distinct < pairs.count()


def test_scores_are_the_same_with_and_without_the_table_of_titles(spark):
    rnd = random.Random(5)
    columns = "appointment_id string, person_id int, person_name string, post_name string, post_rank string, organisation_short_name string, is_on_leave boolean, is_acting boolean, leave_reason string, start_date date, end_date date"

    def side(name, titles, n):
        made = [(f"{name}{i}", rnd.randint(1, 4), "p", rnd.choice(titles), None, rnd.choice(["A", "B", None]), False, False, None, dt.date(2000, 1, rnd.randint(1, 28)), None) for i in range(n)]
        return spark.createDataFrame(made, columns)

    few = ["Minister for the Army", "Minister for Army", None, "", "minister"]
    core, ext = side("c", few, 40).withColumns({"mp_peer": F.lit(None).cast("string"), "cabinet_status": F.lit("x")}), side("e", few + ["Army"], 40)
    once = score_candidates(core, ext, AS_OF)
    assert "_own_title" in once._jdf.queryExecution().analyzed().toString()
    apart = core.withColumn("post_name", F.concat("post_name", F.lit(" "), "appointment_id")), ext.withColumn("post_name", F.concat("post_name", F.lit(" "), "appointment_id"))
    assert "_own_title" not in score_candidates(*apart, AS_OF)._jdf.queryExecution().analyzed().toString()
    direct = {}
    for r in core.alias("c").join(ext.alias("e"), "person_id").select("c.appointment_id", F.col("e.appointment_id").alias("other"), F.col("c.post_name").alias("a"), F.col("e.post_name").alias("b")).collect():
        direct[r["appointment_id"], r["other"]] = (r["a"], r["b"])
    from tests.test_similarity import ratio

    import re

    short = lambda t: re.sub("(?i) the ", " ", t)
    found = once.collect()
    assert len(found) == len(direct)
    for r in found:
        a, b = direct[r["appointment_id_core"], r["appointment_id_ext"]]
        want = None if a is None or b is None else max(ratio(a, b), ratio(short(a), short(b))) / 100
        assert r["post_name_match"] == (want if want is None else pytest.approx(want))


# gates


def test_gate_refuses_and_leaves_the_earlier_run(spark):
    path = new_path(spark, "gated")
    df = spark.createDataFrame([(1, "/a"), (2, "/b")], "id int, href string")
    measures = gates.Measures()
    known = gates.publish(
        measures.watch("links", df, off=gates.lacking_prefix("href", "/"), longest=gates.longest("href")), path, "r1", gates.Gate({"prefix": lambda m: m["links.off"] == 0}, ("id",)), measures
    )
    assert known == {"links.rows": 2, "links.off": 0, "links.longest": 2, "run.rows": 2, "run.repeated_id": 0}
    bad = spark.createDataFrame([(1, "/a"), (1, "b")], "id int, href string")
    measures = gates.Measures()
    with pytest.raises(gates.Refused) as refused:
        gates.publish(measures.watch("links", bad, off=gates.lacking_prefix("href", "/")), path, "r1", gates.Gate({"prefix": lambda m: m["links.off"] == 0}, ("id",)), measures)
    assert refused.value.failed == ["prefix", "unique id"] and refused.value.measures["links.off"] == 1
    assert rows_of(tables.read_snapshot(spark, path, "r1").select("id", "href")) == rows_of(df)
    # what the gate wrote first is gone
    assert not [d for d in os.listdir(os.path.dirname(path.removeprefix("file://"))) if d.startswith("run-")]


LISTING = '<ul class="gem-c-document-list">{}</ul>'
ENTRY = '<li><a data-ga4-ecommerce-content-id="c{0}" href="{1}{0}">Name {0}</a></li>'


def test_listing_is_published_only_whole(spark):
    path = new_path(spark, "listing")
    page = lambda *e: LISTING.format("".join(ENTRY.format(n, prefix) for n, prefix in e))
    good = spark.createDataFrame([(page((1, "/government/people/"), (2, "/government/people/")),), (page((3, "/government/people/")),)], "html string")
    known = people.publish_listing(good, path, dt.date(2024, 1, 1))
    assert known["links.rows"] == 3 and known["links.off_prefix"] == 0 and tables.read_snapshot(spark, path).filter("slug is not null").count() == 3
    with pytest.raises(gates.Refused, match="prefix"):
        people.publish_listing(spark.createDataFrame([(page((1, "/x/")),)], "html string"), path, dt.date(2024, 1, 2))
    with pytest.raises(gates.Refused, match="unique id"):
        people.publish_listing(good.unionByName(good), path, dt.date(2024, 1, 2))
    names = spark.createDataFrame([("p1", "Name 1"), ("p2", "Nane 3"), ("p2", "Name 2"), ("p3", None)], "id string, name string")
    listed = tables.read_snapshot(spark, path, dt.date(2024, 1, 1)).select("id", "name", "slug")
    suggested = people.publish_matches(names, listed, path + "-matches", "r1")
    assert suggested["matches.rows"] == suggested["run.rows"] == 3 and suggested["matches.best"] == 100.0
    assert {r["name_df_left"]: r["slug"] for r in tables.read_snapshot(spark, path + "-matches", "r1").collect()}["Nane 3"] == "3"


def test_pages_are_published_only_if_all_are_landed_and_read(spark):
    payload = json.dumps({"content_id": "x", "details": {"full_name": "Ann"}, "links": {"available_translations": [{"locale": "en"}], "role_appointments": []}})
    lookup = spark.createDataFrame([(1, "ann"), (2, "bob")], "id int, slug string")
    raw = spark.createDataFrame([("ann", payload), ("bob", payload)], "slug string, payload string")
    path = new_path(spark, "pages")
    assert pages.publish_pages(lookup, raw, path, "r1")["owned.rows"] == 2
    with pytest.raises(gates.Refused, match="every page landed"):
        pages.publish_pages(lookup, raw.filter("slug = 'ann'"), path, "r2")
    broken = raw.withColumn("payload", F.when(F.col("slug") == "bob", '{"content_id": [').otherwise(F.col("payload")))
    with pytest.raises(gates.Refused, match="every page reads"):
        pages.publish_pages(lookup, broken, path, "r2")
    assert [(r["slug"], r["reason"]) for r in pages.set_aside(broken).collect()] == [("bob", "broken")]
    ids = [r["row_id"] for r in pages.flat_pages(lookup, raw, random_ids=True).collect()]
    assert len(set(ids)) == len(ids) == 2 and all(len(i) == 36 for i in ids)


def test_unreadable_pages_and_drift(spark):
    from pyspark.sql import types as T

    schema = T.StructType.fromDDL("id int, a struct<x: int, l: array<struct<y: int>>>")
    texts = ['{"id":1,"a":{"x":1,"l":[{"y":1,"z":2}]}}', '{"id":2,"a":', "", None, '{"id":3,"a":"text"}', '{"id":4,"b":5}', "[1]", "{}"]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, payload string")
    aside = {r["n"]: r["reason"] for r in payloads.unreadable(df, schema).collect()}
    read = {r["n"]: (r["id"], r["a"]) for r in payloads.parse_payload(df, schema).collect()}
    assert aside[1] == "broken" and aside[4] == "drifted" and set(aside) | set(read) == set(range(8)) and not set(aside) & set(read)
    assert read[0][1].l[0].y == 1 and read[3] == (None, None) and read[5] == (4, None)
    drift = {r["path"]: (r["asked"], r["pages"]) for r in payloads.schema_drift(df, schema).collect()}
    assert drift == {"id": (True, 3), "a": (True, 2), "a.x": (True, 1), "a.l": (True, 1), "a.l.y": (True, 1), "a.l.z": (False, 1), "b": (False, 1)}


# buckets


def files_of(path):
    place = path.removeprefix("file://")
    return {d: sorted((n, os.path.getmtime(os.path.join(place, d, n))) for n in os.listdir(os.path.join(place, d))) for d in os.listdir(place) if d.startswith("bucket=")}


def test_only_touched_buckets_are_written_again(spark):
    path = new_path(spark, "buckets")
    df = spark.range(400).select(F.col("id").cast("string").alias("id"), F.lit("p0").alias("post_id"))
    tables.write_buckets(df, path, "id", 16)
    before = files_of(path)
    edits = spark.createDataFrame([("7", "p9"), ("8", "p9")], "target_appointment_id string, new_post_id string")
    keys = edits.select(F.col("target_appointment_id").alias("id"))
    n = tables.rewrite_buckets(spark, path, "id", 16, keys, lambda rows: changes.apply_edits(rows, edits)[0])
    after = files_of(path)
    assert len(before) == 16 and 1 <= n <= 2 and sum(before[b] != after[b] for b in before) == n
    assert rows_of(tables.read_buckets(spark, path).filter("post_id = 'p9'").select("id")) == ["('7',)", "('8',)"] and tables.read_buckets(spark, path).count() == 400
    assert tables.rewrite_buckets(spark, path, "id", 16, keys.filter("false"), lambda rows: rows) == 0


# blocking


def test_blocking_finds_near_names_and_says_how_many(spark):
    rnd = random.Random(2)
    words = ["amber", "birch", "cedar", "delta", "ember", "fjord", "grove", "heath", "islet", "jetty"]
    names = sorted({f"{rnd.choice(words)} {rnd.choice(words)} {rnd.randint(1, 99)}" for _ in range(300)})
    right = spark.createDataFrame([(n,) for n in names], "name string")
    left = spark.createDataFrame([(n[:3] + n[4:],) for n in names[:120]] + [("",), (None,), ("zzz",), (names[5],)], "name string")
    found = {r["left_name"]: r["score"] for r in blocking.blocked_names(left, right, "name", "name").collect()}
    exact = {r["left_name"]: r["score"] for r in nearest_names(left, right, "name", "name").collect()}
    assert all(found[n] <= exact[n] + 1e-9 for n in found) and found[names[5]] == 100
    row = blocking.blocking_recall(left, right, "name", "name", share=1.0).first()
    good = sum(n in found and found[n] >= exact[n] - 1e-9 for n in exact)
    assert (row["names"], row["found"]) == (len(exact), good) and row["recall"] >= 0.9
    part = blocking.name_sample(left, "name", 0.3)
    assert 0 < part.count() < 90 and rows_of(part) == rows_of(blocking.name_sample(left.repartition(7), "name", 0.3))


def test_topics(spark):
    cases = {
        "Minister for Care": "Care", "Minister of State for Care (joint with X)": "Care", "Minister for A and Minister for B": "A and B", "Minister for A, and Minister of State for B": "A, and B",
        "Minister for Trade (Yorkshire and the Humber)": "Yorkshire and the Humber", "Minister for Yorkshire and the Humber": "Yorkshire and the Humber", "Chancellor": "Chancellor",
    }
    df = spark.createDataFrame(list(cases.items()), "t string, want string")
    assert all(r["got"] == r["want"] for r in df.select("want", post_topic(F.col("t")).alias("got")).collect())
    nested = spark.createDataFrame([("Minister for A (Big Red Ball)",)], "t string")
    assert nested.select(post_topic(F.col("t"), ("Red", "Big Red Ball", "Ball")).alias("x")).first()["x"] == "Big Red Ball"
    assert nested.select(post_topic(F.col("t"), ()).alias("x")).first()["x"] == "A"


def test_titles_repeat_counts_bounds(spark):
    left = spark.createDataFrame([(1, f"t{i % 2}") for i in range(10)], "person_id int, post_name_a string")
    right = spark.createDataFrame([(1, f"t{i}") for i in range(10)], "person_id int, post_name_b string")
    sizes = person_sizes(left, right, "_a", "_b")
    assert (sizes.row_pairs, sizes.title_pairs) == (100.0, 20.0) and titles_repeat(left, right, "_a", "_b", sizes) is True
    other = right.withColumnRenamed("post_name_b", "post_name_a")
    assert titles_repeat(other, right, "_a", "_b", person_sizes(other, right, "_a", "_b")) is False
    none = left.filter("false")
    assert titles_repeat(none, right, "_a", "_b", person_sizes(none, right, "_a", "_b")) is False
    assert quality.row_counts(a=left, b=right).first().rows_agree
