import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollbook.contracts import PAGE_CONTENT, PEOPLE_STRINGS, cast_to_contract, lower_ids
from rollbook.operators import quality
from rollbook.plans.appointments import listed_appointments
from rollbook.plans.pages import clean_pages, flat_pages
from rollbook.plans.people import listed_people
from rollbook.session import land, new_path, scratch
from rollbook.sources import links, payloads, tables

LISTING = """<html><ul class="nav"><li><a href="/x">no</a></li></ul>
<UL id='l' class='a gem-c-document-list b'>
 <li class="i"><a data-ga4-ecommerce-content-id="c1" class="k" href="/government/people/ann-lee"> Ann &amp; <b>Lee</b></a> text</li>
 <li>no link</li>
 <li><a href='/government/people/bob' data-ga4-ecommerce-content-id='c2'>Bob</a><a href="/second">2</a></li>
</UL><div class="x some-pagination__next"><a class="p" href="/government/people?page=2">Next</a></div></html>"""
LAST = '<ul class="gem-c-document-list"></ul><div class="other"><a href="/n">x</a></div>'


def listing(spark):
    rows = [(1, "https://h.example/government/people?page=1", LISTING), (2, "https://h.example/p2", LAST), (3, "https://h.example/p3", None)]
    return spark.createDataFrame(rows, "page int, url string, html string")


NESTED = """<p><!-- <ul class="gem-c-document-list"><li><a href="/no">no</a></li></ul> --></p><ul class="gem-c-document-list">
<li><a href="/a">A &eacute;</a><ul><li><a href="/a/1">A1</a></li></ul></li><li><a href=/b>B</a></li></ul>"""


def test_every_entry_of_odd_pages_is_read(spark):
    odd = [
        LISTING, NESTED, None, NESTED.replace("</ul></li><li>", "</ul><li>"), "", "<ul class='gem-c-document-list'><li><a href='/x'>open",
        NESTED.replace("<a href=\"/a\">", '<a title="a > b <li>" HREF=\'/a"b\'>'),
        NESTED.replace("A1", "A<b>&amp;1</b><!-- <a href='/z'>z</a> -->&copy; &copyx &#233;&#xe9;&#128;&nosuch; &lt;b&gt; &#55296;&"),
        NESTED.replace("<p>", "<script>'<ul class=\"gem-c-document-list\"><li><a href=/s>s</a>'</script><title><ul></title><p>"),
        NESTED.replace("<li><a href=/b>", "<li>no link</li><li><ul><li><ul><li><a href='/deep?a=1&amp;b=2' data-ga4-ecommerce-content-id='d'>deep</a><a href=/b2>2</a></li></ul>x</li></ul><a href=/b>"),
        NESTED + NESTED, NESTED.replace("</a>", ""), "<ul><li><a href='/not'>not the class</a></li></ul>" + NESTED,
        "<UL CLASS='x  gem-c-document-list'>" + "".join(f"<LI><A HREF='/p{i}'>n{i}<br/></A></LI>" for i in range(3000)) + "</UL>",
    ]
    pages = spark.createDataFrame(list(enumerate(odd)), "page int, html string")
    for list_class in (links.LIST_CLASS, None):
        ours, parser = (sorted((tuple(r) for r in links.page_links(pages, ["page"], list_class=list_class, reader=r).collect()), key=str) for r in ("expression", "parser"))
        assert ours == parser and len(ours) > 3000
    plan = links.page_links(pages, ["page"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InPandas" not in plan and plan.count("Scan") == 1
    got = [tuple(r) for r in links.page_links(pages, ["page"]).collect()]
    assert [(r[2], r[3]) for r in got if r[0] == 1] == [("A é", "/a"), ("A1", "/a/1"), ("B", "/b")]


@pytest.mark.parametrize("reader", ["expression", "parser"])
def test_links_of_a_listing(spark, reader):
    got = sorted(map(tuple, links.page_links(listing(spark), ["page"], reader=reader).collect()))
    assert got == [(1, "c1", " Ann & Lee", "/government/people/ann-lee"), (1, "c2", "Bob", "/government/people/bob")]


def test_next_pages_and_missing_ones(spark):
    pages = listing(spark)
    base = "https://h.example/"
    got = {r.page: r.n for r in pages.select("page", links.next_page("html", base).alias("n")).collect()}
    assert got == {1: "https://h.example/government/people?page=2", 2: None, 3: None}
    assert [r.next_url for r in links.missing_pages(pages, base).collect()] == ["https://h.example/government/people?page=2"]
    landed = pages.withColumn("url", F.when(F.col("page") == 2, "https://h.example/government/people?page=2").otherwise(F.col("url")))
    assert links.missing_pages(landed, base).count() == 0


def test_urls(spark):
    df = spark.createDataFrame([("/a",), ("b?c",), ("https://o.example/x",), ("//o.example/y",), ("?page=2",)], "h string")
    got = [r[0] for r in df.select(links.resolve_url(F.col("h"), "https://h.example/")).collect()]
    assert got == ["https://h.example/a", "https://h.example/b?c", "https://o.example/x", "https://o.example/y", "https://h.example/?page=2"]


def test_listed_people(spark):
    got = {(r.name, r.slug) for r in listed_people(listing(spark)).collect()}
    assert got == {(" Ann & Lee", "ann-lee"), ("Bob", "bob")}


def page(name, roles, locales=("en", "cy")):
    def role(r):
        title, kind, start, end, organisations = r
        return {
            "content_id": f"a-{title}",
            "details": {"started_on": start, "ended_on": end},
            "links": {"role": [{"content_id": f"r-{title}", "title": title, "document_type": kind, "links": {"ordered_parent_organisations": organisations}}]},
        }

    return json.dumps(
        {
            "content_id": f"p-{name}", "details": {"full_name": f" {name}\n", "body": "unread"},
            "links": {"available_translations": [{"locale": code} for code in locales], "role_appointments": None if roles is None else [role(r) for r in roles]},
        }
    )


HOME = {"content_id": "o1", "title": "Home Office", "analytics_identifier": "D16", "details": {"acronym": "HOFF"}}
DEPARTMENT = {"content_id": "o2", "title": "Ministry of Defence", "analytics_identifier": "d17", "details": {"acronym": "MOD"}}


def test_pages_to_cleaned_content(spark):
    roles = [
        ("Minister of State (Crime & Policing)", "ministerial_role", "2020-01-01", None, [DEPARTMENT, HOME]),
        ("Government Whip", "ministerial_role", "2020-01-01", "2020-01-02", [DEPARTMENT]),  # a day
        ("President of the Board of Trade", "ministerial_role", "2020-01-01", None, [DEPARTMENT]),
        ("Chair", "board_member_role", "2020-01-01", None, [DEPARTMENT]),
        ("Minister for Women and Equalities", "ministerial_role", "2020-01-01", "2021-01-01", []),
    ]
    lookup = spark.createDataFrame([(1, "ann"), (2, "bob"), (3, "not landed")], "id int, slug string")
    raw = spark.createDataFrame([("ann", page("Ann", roles)), ("bob", page("Bob", None))], "slug string, payload string")
    flat = flat_pages(lookup, raw)
    # Ann: 2 locales x (2 + 1 + 1 + 1 + 1); Bob: 2 locales, no role
    assert flat.count() == 14
    assert {r[0] for r in flat.select("`details.full_name`").collect()} == {"Ann", "Bob"}
    rows = {r.post_name_clean: r for r in clean_pages(lookup, raw).collect()}
    assert set(rows) == {"Minister for Crime and Policing", "Minister for Women and Equalities"}
    crime = rows["Minister for Crime and Policing"]
    assert (crime.person_id, crime.post_rank, crime.organisation_short_name_clean, crime.appointment_end_date) == ("1", "MoS", "MoD", None)
    assert rows["Minister for Women and Equalities"].organisation_short_name_clean == "GEO"
    assert set(PAGE_CONTENT.fieldNames()) <= set(clean_pages(lookup, raw).columns)
    assert listed_appointments(clean_pages(lookup, raw)).count() == 2
    assert quality.row_counts(lookup=lookup, landed=raw).first().rows_agree is False


def test_flatten_keeps_rows_with_null_and_empty_arrays(spark):
    schema = T.StructType.fromDDL("id int, a struct<x: int, l: array<struct<y: int, z: array<int>>>>")
    rows = ['{"id":1,"a":{"x":5,"l":[{"y":1,"z":[7,8]},{"y":2,"z":[]}]}}', '{"id":2,"a":{"x":6,"l":[]}}', '{"id":3,"a":null}']
    df = spark.createDataFrame([(r,) for r in rows], "payload string")
    flat = payloads.flatten(payloads.parse_payload(df, schema))
    assert flat.columns == ["id", "a.x", "a.l.y", "a.l.z"]
    assert sorted(map(str, map(tuple, flat.collect()))) == sorted(
        str(r) for r in [(1, 5, 1, 7), (1, 5, 1, 8), (1, 5, 2, None), (2, 6, None, None), (3, None, None, None)]
    )
    pruned = payloads.flatten(payloads.parse_payload(df, schema, paths=["id", "a.l.y"]))
    assert pruned.columns == ["id", "a.l.y"] and pruned.count() == 4


def test_snapshots_replace_one_run(spark):
    path = new_path(spark, "snap")
    df = spark.createDataFrame([(1, "a", "s")], "id int, name string, slug string")
    tables.write_snapshot(df, path, dt.date(2021, 10, 9), PEOPLE_STRINGS)
    tables.write_snapshot(df, path, dt.date(2022, 7, 2), PEOPLE_STRINGS)
    tables.write_snapshot(df.withColumn("name", F.lit("b")), path, dt.date(2022, 7, 2), PEOPLE_STRINGS)
    assert tables.read_snapshot(spark, path).count() == 2
    one = tables.read_snapshot(spark, path, dt.date(2022, 7, 2))
    assert [tuple(r) for r in one.collect()] == [("1", "b", "s")]
    assert "PartitionFilters: [isnotnull(run_date" in one._jdf.queryExecution().executedPlan().toString()


def test_write_once_and_rewrite(spark):
    path = new_path(spark, "once")
    df = spark.range(3)
    tables.write_once(df, path)
    with pytest.raises(Exception, match="already exists"):
        tables.write_once(df, path)
    with pytest.raises(ValueError):
        tables.rewrite(df, path, path + "/")
    tables.rewrite(spark.range(5), path + "-2", path)
    assert tables.read_table(spark, path + "-2").count() == 5 and land(df, "x").count() == 3


def test_match_sheet_round_trip(spark):
    path = new_path(spark, "sheet")
    df = spark.createDataFrame(
        [("l2", "r", 1, 90.5, "a,b", 'q"t', "s"), ("l1", "r", 2, 1.0, "a", "b", None)],
        "df_left_id string, df_right_id string, duplicate_flag_df_left int, match_score double, name_df_left string, name_df_right string, slug string",
    )
    tables.write_match_sheet(df, path)
    back = tables.read_match_sheet(spark, path)
    assert back.columns[-3:] == ["accept", "replacement_name", "replacement_slug"]
    got = {r.df_left_id: r for r in back.collect()}
    assert got["l2"].name_df_left == "a,b" and got["l2"].accept is None and got["l2"].match_score == 90.5


def test_script_has_prologue_first(spark):
    path = new_path(spark, "script")
    df = spark.createDataFrame([("b", "two;"), ("a", "one;")], "name string, statement string")
    tables.write_script(df, path, "set noexec on", ["name"])
    assert [r.value for r in spark.read.text(path).coalesce(1).collect()] == ["set noexec on", "one;", "two;"]


def test_lines_are_numbered_without_a_file_in_one_value(spark, monkeypatch):
    held = []
    monkeypatch.setattr(tables, "land", lambda df, name: held.append(df) or land(df, name), raising=False)
    path = new_path(spark, "lines")
    wanted = [f"line {i}\r{'x' * (i % 7)}" if i % 5 else "" for i in range(3000)]
    frame = spark.createDataFrame(list(enumerate(wanted)), "i int, value string")
    frame.repartitionByRange(3, "i").sortWithinPartitions("i").select("value").write.text(path)
    small = {"spark.sql.files.maxPartitionBytes": "2048", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        got = tables.read_lines(spark, path).orderBy("line").collect()
        assert [tuple(r) for r in got] == list(enumerate(wanted, 1))
        assert held and held[0].rdd.getNumPartitions() > 3 and held[0].agg(F.max(F.length("value"))).first()[0] == max(map(len, wanted))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_contracts(spark):
    df = spark.createDataFrame([("AB-C", 1, "s", "extra")], "id string, name int, slug string, other string")
    assert tuple(cast_to_contract(lower_ids(df, "id"), PEOPLE_STRINGS).first()) == ("ab-c", "1", "s")
    with pytest.raises(Exception):
        cast_to_contract(df.drop("slug"), PEOPLE_STRINGS).collect()


def test_quality_checks(spark):
    df = spark.createDataFrame([("a", None), ("b", "x"), ("b", None)], "u string, v string")
    found = {r.column_name: (r.rows, r.distinct_values, r.is_unique) for r in quality.uniqueness(df, ["u", "v"]).collect()}
    assert found == {"u": (3, 2, False), "v": (3, 1, False)}
    assert [tuple(r) for r in quality.duplicates(df, ["v"]).collect()] == [(None, 2)]
    assert tuple(quality.length_profile(df, ["u"]).first()) == (1,)
    assert tuple(quality.all_start_with(df, "u", "b").first()) == (1, False)
    twins = quality.orphans(df, "u", F.col("v").isNull(), F.col("v") == "x")
    assert [r.u for r in twins.collect()] == ["a"]
    counted = quality.count_targets(
        df.select(F.col("u").alias("c")).distinct(), df, F.col("c") == F.col("u"), ["c"], "u"
    )
    good, aside = quality.split_by_cardinality(counted)
    assert [r.c for r in good.collect()] == ["a"] and [r.c for r in aside.collect()] == ["b"]


def test_scratch_is_deleted_by_its_owner(spark):
    with scratch(spark):
        inner = land(spark.range(3), "scratch")
        place = inner.inputFiles()[0]
        assert inner.count() == 3 and os.path.exists(place.removeprefix("file://"))
    assert not os.path.exists(place.removeprefix("file://"))
