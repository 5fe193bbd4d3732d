import pytest
from pyspark.sql import functions as F

from rollbook.functions.dates import parse_date
from rollbook.functions import fixed_rules, titles
from rollbook.functions.names import post_topic, strip_name_affixes
from rollbook.functions.rules import Rule, first_match, house_to_kind, seniority_group
from rollbook.functions.text import strip
from rollbook.operators.cleaning import clean_names

# title, name, rank, on leave, acting
GOLDEN = [
    ("Minister for Sport, Tourism and Civil Society, and Minister for Equalities", "Minister for Sport, Tourism and Civil Society", None, False, False),
    ("Minister on Leave (Attorney General)", "Attorney General", None, True, False),
    ("Minister on Leave (Minister of State)", "Minister of State", "MoS", True, False),
    ("Interim Minister of State for Energy and Clean Growth", "Minister for Energy and Clean Growth", "MoS", False, True),
    ("Interim Parliamentary Secretary (Minister for the Constitution)", "Minister for the Constitution", "PUSS", False, True),
    ("Parliamentary Under Secretary of State for Sport, Tourism and Heritage (maternity cover)", "Minister for Sport, Tourism and Heritage", "PUSS", False, True),
    ("Minister of State (Climate, Environment and Energy – joint with FCDO and Defra)", "Minister for Climate, Environment and Energy", "MoS", False, False),
    ("Minister of State for Civil Justice (Lords Minister)", "Minister for Civil Justice", "MoS", False, False),
    ("Parliamentary Under Secretary of State for Arts and Heritage and DCMS Lords Minister", "Minister for Arts and Heritage", "PUSS", False, False),
    ("Minister for Policing, Fire and Criminal Justice and Victims", "Minister for Policing, Fire and Criminal Justice and Victims", None, False, False),
    ("Parliamentary Under Secretary of State for Environment and Rural Affairs", "Minister for Environment and Rural Affairs", "PUSS", False, False),
    ("Minister of State (Crime and Policing)", "Minister for Crime and Policing", "MoS", False, False),
    ("Parliamentary Under Secretary of State (Americas, Caribbean and the Overseas Territories)", "Minister for Americas, Caribbean and the Overseas Territories", "PUSS", False, False),
    ("Minister of State (Minister for Africa)", "Minister for Africa", "MoS", False, False),
    ("Parliamentary Under Secretary of State (Minister for AI and Intellectual Property)", "Minister for AI and Intellectual Property", "PUSS", False, False),
    ("Minister of State at the Northern Ireland Office", "Minister of State", "MoS", False, False),
    ("Minister of State for Asia and the Pacific at the Foreign & Commonwealth Office", "Minister for Asia and the Pacific", "MoS", False, False),
    ("Minister of State for Cabinet Office", "Minister of State", "MoS", False, False),
    ("Minister of State for Cabinet Office (Cities and Constitution)", "Minister for Cities and Constitution", "MoS", False, False),
    ("Parliamentary Under Secretary of State and Minister for Defence Procurement", "Minister for Defence Procurement", "PUSS", False, False),
    ("Parliamentary Under Secretary of State, Minister for Faith", "Minister for Minister for Faith", "PUSS", False, False),
    ("Parliamentary Under Secretary of State and Minister for Defence Equipment, Support and Technology (including Defence Exports)", "Minister for Defence Equipment, Support and Technology (including Defence Exports)", "PUSS", False, False),
    ("Parliamentary Secretary (Minister for Civil Society)", "Minister for Civil Society", "PUSS", False, False),
    ("Parliamentary Secretary for the Constitution", "Minister for the Constitution", "PUSS", False, False),
    ("Parliamentary Secretary to the Treasury (Chief Whip)", "Chief Whip", "Parl. lead.", False, False),
    ("Minister on Leave of nobody", "Minister on Leave of nobody", None, True, False),
    ("Minister on Leave (Interim Minister of State for A and for B)", "Minister for A and for B", "MoS", True, True),
    ("Parliamentary Under-Secretary of State for the Army, and for the Navy", "Minister for the Army, and for the Navy", "PUSS", False, False),
    ("", "", None, False, False),
    (None, None, None, False, False),
]


def test_golden_titles(spark):
    df = spark.createDataFrame([(i, g[0]) for i, g in enumerate(GOLDEN)], "id int, t string")
    rows = {r.id: r for r in titles.normalise_titles(df, "t", "rank").collect()}
    for i, (_, name, rank, leave, acting) in enumerate(GOLDEN):
        r = rows[i]
        assert (r.t, r.rank, r.is_on_leave, r.is_acting) == (name, rank, leave, acting), GOLDEN[i]
        assert r.leave_reason == ("Maternity leave" if leave else None)
        assert r.title_unreadable == (GOLDEN[i][0] == "Minister on Leave of nobody")


def test_known_defects_can_be_fixed(spark):
    rows = [
        ("Parliamentary Under Secretary of State, Minister for Faith",),
        ("Minister of State and Minister for the Cabinet Office (Minister for Cities)",),
    ]
    df = spark.createDataFrame(rows, "t string")
    fixed = {r.t for r in titles.standardise_rank(df, "t", "rank", fix_known_defects=True).collect()}
    kept = {r.t for r in titles.standardise_rank(df, "t", "rank").collect()}
    assert fixed == {"Minister for Faith", "Minister of State and Minister for Cities"}
    assert kept == {"Minister for Minister for Faith", "Minister of State and Minister for  Cities"}


def test_only_the_first_lords_form_applies(spark):
    df = spark.createDataFrame([("A (Lords Minister for B) and Lords Minister",)], "t string")
    assert df.select(titles.drop_lords(F.col("t")).alias("t")).first().t == "A (Minister for B) and Lords Minister"


def test_normalisers_stay_in_the_jvm(spark):
    df = titles.normalise_titles(spark.createDataFrame([("x",)], "t string"), "t", "rank")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_every_exact_title_rule_fires(spark):
    rules = fixed_rules.POST_NAME_RULES
    rows = [(i, r.titles[0], r.persons[0] if r.persons else "Anyone", None, None) for i, r in enumerate(rules)]
    df = spark.createDataFrame(
        rows, "id int, post_name string, person_name string, organisation_name string, organisation_short_name string"
    )
    got = {r.id: r.post_name_clean for r in clean_names(df).collect()}
    assert got == {i: r.result for i, r in enumerate(rules)}


def test_rules_by_person_blank_and_order(spark):
    schema = "id int, post_name string, person_name string, organisation_name string, organisation_short_name string"
    df = spark.createDataFrame(
        [
            (1, "Government Whip", "Somebody", None, None),
            (2, "Lord in Waiting (Government Whip)", "X", None, None),
            (3, "Government Whip", "X", "Cabinet Office", "CAB"),
            (4, "Minister for Women and Equalities", "X", None, None),
            (5, "Minister for Women and Equalities", "X", "Home Office", "HOFF"),
            (6, None, None, None, "MOD"),
        ],
        schema,
    )
    got = {r.id: (r.post_name_clean, r.organisation_name_clean, r.organisation_short_name_clean) for r in clean_names(df).collect()}
    assert got[1] == ("Government Whip", "Government Whips-House of Commons", "Whip Commons")
    # the rule's own text ends in a blank
    assert got[2] == ("Lord in Waiting", "Government Whips-House of Lords", "Whip Lords")
    # by title in one table, by organisation first in the other
    assert got[3] == ("Government Whip", "Government Whips-House of Commons", "CO")
    assert got[4][1:] == ("Government Equalities Office", "GEO")
    assert got[5][1:] == ("Home Office", "HO")
    assert got[6] == (None, None, "MoD")


def test_collation_makes_rules_ignore_case(spark):
    rules = (Rule("hit", titles=("Some Title ",)),)
    df = spark.createDataFrame([("SOME title",), ("other",)], "post_name string")
    plain = [r.r for r in df.select(first_match(rules, F.lit("miss")).alias("r")).collect()]
    folded = [r.r for r in df.select(first_match(rules, F.lit("miss"), "UTF8_LCASE").alias("r")).collect()]
    assert plain == ["miss", "miss"] and folded == ["hit", "miss"]


def test_small_mappings(spark):
    df = spark.createDataFrame([("Commons", "MoS"), ("Lords", "PUSS"), ("Other", "SoS"), (None, None)], "h string, r string")
    got = [tuple(r) for r in df.select(house_to_kind(F.col("h")), seniority_group(F.col("r"))).collect()]
    assert got == [("MP", "MoS/PUSS"), ("Peer", "MoS/PUSS"), (None, "SoS"), (None, None)]


@pytest.mark.parametrize(
    "name,kept,stripped",
    [
        ("The Rt Hon Ann Lee MP", "Ann Lee", "Ann Lee"),
        ("Rt Hon Sir Bob Stone KC MP", "Bob Stone", "Bob Stone"),
        ("Baroness Penn", "Baroness Penn", "Penn"),
        ("Mrs. Theresa Hon", "Theresa Hon", "Theresa Hon"),
        ("Drew Mann", "Drew Mann", "Drew Mann"),
    ],
)
def test_name_affixes(spark, name, kept, stripped):
    df = spark.createDataFrame([(name,)], "n string")
    row = df.select(strip_name_affixes(F.col("n")).alias("a"), strip_name_affixes(F.col("n"), exclude_peerage=False).alias("b")).first()
    assert (row.a, row.b) == (kept, stripped)


def test_topics_and_blanks(spark):
    titles_in = ["Minister for Safe and Legal Migration", "Minister of State for Trade (joint)", "Attorney General", "Minister for X (Yorkshire and the Humber)"]
    df = spark.createDataFrame([(t,) for t in titles_in], "t string")
    got = [r[0] for r in df.select(post_topic(F.col("t"))).collect()]
    assert got == ["Safe and Legal Migration", "Trade", "Attorney General", "Yorkshire and the Humber"]
    odd = spark.createDataFrame([("   a b\x1c\n ",)], "t string")
    assert odd.select(strip(F.col("t"))).first()[0] == "   a b\x1c\n ".strip()


def test_dates_keep_the_written_day(spark):
    texts = {
        "2015-05-11": "2015-05-11", "2015-05-11T00:00:00+01:00": "2015-05-11", " 2015-05-11 23:59:59-08:00": "2015-05-11",
        "2015-05-11T23:30:00.5Z": "2015-05-11", "not known": None, "": None, " ": None, "2015-13-01": None, "2015-05-11x": None, None: None,
    }
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", parse_date(F.col("t")).cast("string")).collect()
    assert {r[0]: r[1] for r in rows} == texts
