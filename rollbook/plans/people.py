"""People of the core database against the public listing of people."""

from __future__ import annotations

import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.contracts import by_value
from rollbook.functions.dates import or_latest
from rollbook.functions.names import strip_name_affixes
from rollbook.operators.changes import stable_id
from rollbook.operators.fuzzy import fuzzy_merge
from rollbook.operators.gates import Gate, Measures, lacking_prefix, longest, publish
from rollbook.operators.ranking import rank_within
from rollbook.session import scratch
from rollbook.sources.links import PERSON_PREFIX, page_links, person_slug

# Fixed value: appointments that ended by this day are not looked for
SERVED_AFTER = datetime.date(2010, 5, 11)


def listed_people(pages: DataFrame, **options) -> DataFrame:
    """id, name, slug of every entry on the landed listing pages."""
    links = page_links(pages, [], **options)
    return links.select(stable_id(F.col("content_id"), F.col("href")).alias("id"), "name", person_slug(F.col("href")).alias("slug"))


def unmatched_people(
    person: DataFrame, appointment: DataFrame, known: DataFrame, served_after: datetime.date = SERVED_AFTER
) -> DataFrame:
    """People with a late enough appointment whose id, in whatever case, is in no earlier match."""
    person, appointment, known = by_value(person, "id"), by_value(appointment, "person_id"), by_value(known, "id")
    recent = (
        appointment.filter(or_latest(F.col("end_date")) > F.lit(served_after))
        .select(F.col("person_id").alias("id"))
        .distinct()
    )
    return person.join(recent, "id", "left_semi").join(known.select("id").distinct(), "id", "left_anti")


def publish_listing(pages: DataFrame, path: str, run: str | datetime.date, prefix: str = PERSON_PREFIX, **options) -> dict[str, int]:
    """Read the people of the listing pages and publish them as a run: distinct ids and links, all under the prefix."""
    links = page_links(pages, [], **options).select(stable_id(F.col("content_id"), F.col("href")).alias("id"), "name", "href")
    measures = Measures()
    watched = measures.watch("links", links, off_prefix=lacking_prefix("href", prefix), longest_name=longest("name"))
    gate = Gate({"links under the prefix": lambda m: m["links.off_prefix"] == 0}, unique=("id", "href"))
    return publish(watched.withColumn("slug", person_slug(F.col("href"), prefix)), path, run, gate, measures)


def publish_matches(people: DataFrame, listed: DataFrame, path: str, run: str | datetime.date, **options) -> dict[str, int]:
    """Match the people and publish the suggestions as a run, if every named row got one (unless a cutoff is set)."""
    wanted = people.filter("name is not null").count() if not options.get("score_cutoff") else 0
    gate = Gate({
        "a suggestion for every name": lambda m: m["run.rows"] >= wanted,
        "scores are ratios": lambda m: not m["run.rows"] or (0 <= m["matches.worst"] and m["matches.best"] <= 100),
    })
    measures = Measures()
    with scratch(people.sparkSession):
        matches = measures.watch("matches", match_people(people, listed, **options), worst=F.min("match_score"), best=F.max("match_score"))
        return publish(matches, path, run, gate, measures)


def match_people(people: DataFrame, listed: DataFrame, limit: int = 1, score_cutoff: float = 0.0) -> DataFrame:
    """Best listed name of every person row, ranked within the person.

    A person under several names has several rows; at most one of their matches
    is to be accepted.
    """
    stripped = listed.withColumn("name", strip_name_affixes(F.col("name")))
    matched = fuzzy_merge(people, stripped, "id", "id", limit=limit, score_cutoff=score_cutoff, carry=("slug",))
    order = [F.desc_nulls_last("match_score"), F.asc("name_df_left"), F.asc("df_right_id")]
    return rank_within(matched, ["df_left_id"], order, "duplicate_flag_df_left")


def accepted_matches(sheet: DataFrame) -> DataFrame:
    """(id, name, slug): accepted suggestions, and replacements of rejected ones."""
    taken = sheet.filter(F.col("accept") == "Y").select(
        F.col("df_left_id").alias("id"), F.col("name_df_left").alias("name"), "slug"
    )
    replaced = sheet.filter((F.col("accept") == "N") & F.col("replacement_name").isNotNull()).select(
        F.col("df_left_id").alias("id"), F.col("name_df_left").alias("name"), F.col("replacement_slug").alias("slug")
    )
    return taken.unionByName(replaced)


def reference_table(*runs: DataFrame) -> DataFrame:
    """Distinct (id, name, slug) over all runs; the first called the name otherwise."""
    named = [r.withColumnRenamed("minister_name", "name").select("id", "name", "slug") for r in runs]
    return reduce(DataFrame.unionByName, named).distinct()
