import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from rollbook.contracts import WORKFLOW
from rollbook.operators import changes, review, statements
from rollbook.operators.matching import for_export, score_candidates

AS_OF = dt.date(2024, 6, 1)
SIDE = (
    "appointment_id string, person_id int, person_name string, post_name string, organisation_short_name string, post_rank string,"
    " is_on_leave boolean, is_acting boolean, leave_reason string, start_date date, end_date date"
)


def side(spark, rows, core=False):
    """rows: (id, person, title, organisation, start, end)"""
    full = [(i, p, f"P{p}", t, o, None, False, False, None, s, e) for i, p, t, o, s, e in rows]
    df = spark.createDataFrame(full, SIDE)
    if core:
        df = df.withColumns({"mp_peer": F.lit("MP"), "cabinet_status": F.lit("x")})
    return df


def day(n):
    return dt.date(2020, 1, 1) + dt.timedelta(days=n)


def test_borderline_dates_follow_the_order_of_operations(spark):
    core = side(spark, [("a", 1, "T", "O", day(100), day(200))], core=True)
    ext = side(spark, [(str(n), 1, "T", "O", day(100 + n), day(200 + 40 - n)) for n in range(41)])
    rows = {int(r.appointment_id_ext): r for r in score_candidates(core, ext, AS_OF).collect()}
    assert {n for n, r in rows.items() if not r.match_accepted} == {6, 7, 33, 34}
    assert all(r.reviewed for r in rows.values())


def test_scores_nulls_and_open_ends(spark):
    core = side(
        spark,
        [("a", 1, "Minister for the Army", "MoD", day(0), None), ("b", 1, None, "MoD", day(0), None), ("c", 2, "T", None, day(0), None), ("d", 3, "T", "O", None, None), ("e", 9, "T", "O", day(0), None)],
        core=True,
    )
    ext = side(spark, [("x", 1, "Minister for Army", "MoD", day(0), AS_OF), ("y", 2, "T", None, day(150), None), ("z", 3, "T", "O", day(0), None)])
    rows = {(r.appointment_id_core, r.appointment_id_ext): r for r in score_candidates(core, ext, AS_OF).collect()}
    assert set(rows) == {("a", "x"), ("b", "x"), ("c", "y"), ("d", "z")}
    a = rows["a", "x"]
    assert a.match_score == 1 and a.match_accepted and a.reviewed and a.end_date_core is None and a.end_date_ext == AS_OF
    b = rows["b", "x"]
    assert b.post_name_match is None and b.match_score is None and not b.match_accepted and not b.reviewed
    c = rows["c", "y"]
    assert c.organisation_short_name_match == 0.5 and c.start_date_match == 0 and c.end_date_match == 1
    assert rows["d", "z"].date_match is None and not rows["d", "z"].match_accepted
    assert list(rows["a", "x"].asDict()) == WORKFLOW.fieldNames()


@pytest.mark.parametrize("budget", [20, 10**9])
def test_reviewed_equals_the_window_over_all_candidates(spark, budget):
    rnd = random.Random(2)
    titles = ["Minister for War", "Minister for the War", "Minister for Peace"]

    def rows(tag, n):
        return [
            (f"{tag}{i % (n - 5)}", rnd.choice([1, 1, 2, 3]), rnd.choice(titles), rnd.choice(["A", "B"]), day(rnd.randint(0, 90)),
             rnd.choice([None, day(rnd.randint(90, 160))]))
            for i in range(n)
        ]

    scored = score_candidates(side(spark, rows("c", 40), core=True), side(spark, rows("e", 60)), AS_OF, pair_budget=budget)
    checked = scored.withColumn("w", F.max("match_accepted").over(Window.partitionBy("appointment_id_core")))
    counts = {(r.reviewed, r.w): r["count"] for r in checked.groupBy("reviewed", "w").count().collect()}
    assert counts.keys() == {(True, True), (False, False)}


def test_export_order_puts_nulls_last(spark):
    core = side(spark, [("a", 1, "T", "O", day(0), None), ("b", 1, None, "O", day(0), None)], core=True)
    ext = side(spark, [("x", 1, "T", "O", day(0), None), ("y", 1, "zz", "Q", day(0), None)])
    got = [(r.appointment_id_core, r.match_score) for r in for_export(score_candidates(core, ext, AS_OF)).collect()]
    assert [g[0] for g in got] == ["a", "a", "b", "b"] and got[0][1] > got[1][1]


FLOW = (
    "appointment_id_core string, appointment_id_ext string, person_name_core string, post_name_core string, post_name_ext string,"
    " post_rank_core string, post_rank_ext string, organisation_short_name_core string, organisation_short_name_ext string,"
    " start_date_core date, end_date_core date, start_date_ext date, end_date_ext date, match_score double,"
    " reviewed boolean, match_accepted boolean, replace_post_name boolean, notes string"
)


def flow(spark, rows):
    """rows: (core id, ext id, old title, new title, ext rank, reviewed, accepted, replace)"""
    full = [
        (c, e, "O'Neil", old, new, "MoS", rank, "HO", "HO", day(0), None, day(0), None, 0.9, rev, acc, rep, None)
        for c, e, old, new, rank, rev, acc, rep in rows
    ]
    return spark.createDataFrame(full, FLOW)


def tables(spark):
    organisation = spark.createDataFrame([(1, "HO", None, None), (2, "CO", day(-900), day(900))], "id int, short_name string, start_date date, end_date date")
    post = spark.createDataFrame([(1, 1, "Old", "MoS"), (2, 1, "Known", "MoS"), (3, 1, "Twin", "MoS"), (4, 1, "Twin", "MoS")], "id int, organisation_id int, name string, rank_equivalence string")
    person = spark.createDataFrame([(1, "O'Neil", None, None)], "id int, name string, start_date date, end_date date")
    appointment = spark.createDataFrame([("a", 1, 1, day(0), None), ("z", 1, 2, day(0), None)], "id string, person_id int, post_id int, start_date date, end_date date")
    spell = spark.createDataFrame([("a", day(0), None)], "appointment_id string, start_date date, end_date date")
    return organisation, post, person, appointment, spell


def test_ambiguity_ignores_exempt_titles_and_null_names(spark):
    w = flow(
        spark,
        [("a", "1", "Old", "N1", None, True, True, True), ("a", "2", "Old", "N2", None, False, True, True),
         ("b", "1", "Minister for Women", "N1", None, True, True, True), ("b", "2", "Minister for Women", "N2", None, True, True, True),
         ("c", "1", "Old", "N1", None, True, True, True), ("c", "2", "Old", None, None, True, True, True)],
    )
    assert {r[0] for r in review.ambiguous_appointments(w).collect()} == {"a"}
    assert {r.appointment_id_core for r in review.renames(w).collect()} == {"b", "c"}


def test_change_sets_and_quarantine(spark):
    organisation, post, person, appointment, spell = tables(spark)
    w = flow(spark, [("a", "1", "Old", "New's", None, True, True, True)])
    added = changes.posts_to_add(w, post, organisation)
    assert [tuple(r) for r in added.collect()] == [("New's", "MoS", "HO", None, None)]
    # a known title is not added; neither are rows that are not to be renamed
    known = flow(spark, [("a", "1", "Old", "Known", "MoS", True, True, True), ("b", "1", "Old", "X", None, True, True, False)])
    assert changes.posts_to_add(known, post, organisation).count() == 0

    rows, aside = changes.resolve_new_posts(added, organisation)
    assert aside.count() == 0
    again, _ = changes.resolve_new_posts(added.repartition(3), organisation)
    assert rows.first().id == again.first().id
    twice = organisation.unionByName(organisation.withColumn("id", F.col("id") + 10))
    good, aside = changes.resolve_new_posts(added, twice)
    assert good.count() == 0 and aside.first().n_targets == 2

    full = changes.add_posts(post, rows)
    edits = changes.appointments_to_edit(w)
    held = appointment.withColumn("post_id", F.col("post_id").cast("string"))
    targets = changes.edit_targets(edits, held, spell, person, full, organisation)
    good, aside = changes.resolve_edits(edits, targets)
    assert good.count() == 1 and aside.count() == 0
    moved, clashes = changes.apply_edits(held, good)
    assert {r.id: r.post_id for r in moved.collect()} == {"a": rows.first().id, "z": "2"} and clashes.count() == 0

    # without the new post the edit finds nothing; with two posts of the name it finds too many
    good, aside = changes.resolve_edits(edits, changes.edit_targets(edits, appointment, spell, person, post, organisation))
    assert good.count() == 0 and aside.first().n_targets == 0
    to_twin = changes.appointments_to_edit(flow(spark, [("a", "1", "Old", "Twin", None, True, True, True)]))
    good, aside = changes.resolve_edits(to_twin, changes.edit_targets(to_twin, appointment, spell, person, post, organisation))
    assert good.count() == 0 and aside.first().n_targets == 2

    new_links = changes.relationships_to_add(w, spark.createDataFrame([], "id int, post_id int, group_name string, group_seniority string"), post, organisation)
    links, aside = changes.resolve_new_relationships(new_links, full, organisation)
    row = links.first()
    assert (row.post_id, row.group_name, row.group_seniority) == (rows.first().id, "New's", "MoS/PUSS") and aside.count() == 0


def test_edits_that_disagree_are_set_aside(spark):
    appointment = spark.createDataFrame([("a", "1"), ("b", "1")], "id string, post_id string")
    resolved = spark.createDataFrame([("a", "7"), ("a", "8"), ("b", "9"), ("b", "9")], "target_appointment_id string, new_post_id string")
    moved, clashes = changes.apply_edits(appointment, resolved)
    assert {r.id: r.post_id for r in moved.collect()} == {"a": "1", "b": "9"}
    assert clashes.count() == 2 and {r.target_appointment_id for r in clashes.collect()} == {"a"}


def test_statements_escape_and_compare_nulls(spark):
    organisation, post, *_ = tables(spark)
    added = changes.posts_to_add(flow(spark, [("a", "1", "Old", "New's", None, True, True, True)]), post, organisation)
    text = statements.insert_posts(added).first().statement
    assert "'New''s', 'MoS'" in text and "o.start_date is null" in text and "None" not in text
    null_rank = added.withColumn("post_rank", F.lit(None).cast("string")).withColumn("group_name", F.lit("g"))
    text = statements.insert_relationships(null_rank).first().statement
    assert "'g', NULL" in text and "t.rank_equivalence is null" in text
    move = spark.createDataFrame([("p", "a'b")], "new_post_id string, target_appointment_id string")
    assert statements.update_appointments(move).first().statement == "update core.appointment set post_id = 'p' where id = 'a''b';"


def test_decisions_overwrite_only_what_they_give(spark):
    w = flow(spark, [("a", "1", "Old", "N", None, False, True, False), ("b", "1", "Old", "N", None, False, True, False)])
    decisions = spark.createDataFrame([("a", "1", True, None)], "appointment_id_core string, appointment_id_ext string, reviewed boolean, match_accepted boolean")
    got = {r.appointment_id_core: (r.reviewed, r.match_accepted) for r in review.apply_decisions(w, decisions).collect()}
    assert got == {"a": (True, True), "b": (False, True)}


def test_frozen_end_dates_can_be_undone(spark):
    w = flow(spark, [("a", "1", "Old", "N", None, True, True, True)]).withColumn("end_date_core", F.lit(day(50)))
    assert changes.appointments_to_edit(w).first().end_date == day(50)
    assert changes.appointments_to_edit(w, day(50)).first().end_date == dt.date(9999, 12, 31)
