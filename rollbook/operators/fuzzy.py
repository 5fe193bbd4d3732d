"""Exact nearest names by Indel similarity, without comparing every pair.

Strings whose LCS has L characters, d characters being left over, share at
least L + (q-1) - (q-1)*d grams of q characters once q-1 marks pad either end:
every left-over character breaks at most q-1 of them. So if a left name already
has a match of similarity s, any right name as good shares at least one of its
few rarest grams (prefix filtering, as in set-similarity joins: Chaudhuri et
al. 2006, Xiao et al. 2008).

1. Equal names are settled by an equi-join.
2. A probe on a bounded number of index rows of its rarest grams gives every
   other left name that shares a gram some match, hence s.
3. The prefix of grams that s calls for is joined to an index of the right
   names. All right names with similarity >= s are among the candidates, so
   the best of them is the answer: exact, ties included.

Long grams are selective but need a high s; single characters work for any s.
Each left name uses the length with the fewest index rows to visit. A name with
no near match gets a long prefix and pays for it; nothing is capped.

The index pays where grams are rare. Where many names share their grams it visits
a good part of all pairs, it takes a row on disk for every gram of every name, and an
index row visited costs far more than a bound on one pair in a block of names (``grid``),
where groups of unlike names are ruled out as wholes. So up to ``GRID_PAIRS`` pairs all
blocks are met with all; the result is the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollbook.functions.similarity import indel_ratio
from rollbook.operators.grid import LEFT_BLOCK, RIGHT_BLOCK, nearest_by_grid
from rollbook.operators.skew import PAIR_BUDGET, fan_out, key_sizes, spread_join
from rollbook.session import land

_START, _END = "\u0001", "\u0002"
_SLACK = 1e-9
GRAM_SIZES = (1, 2, 3, 5)
GRID_PAIRS = 10_000_000_000_000  # some thousand CPU seconds where names fall into groups of like ones


def _grams(names: DataFrame, name: str) -> DataFrame:
    """(name, size, q, gram, nth): all grams of each name, repeats numbered."""
    chars = F.when(F.length(name) == 0, F.array().cast("array<string>")).otherwise(F.split(name, ""))
    split = names.select(name, F.length(name).alias("size"), chars.alias("chars"))

    def grams(q: int) -> Column:
        padded = F.concat(
            F.array_repeat(F.lit(_START), q - 1), F.col("chars"), F.array_repeat(F.lit(_END), q - 1)
        )
        # the outer transform is there to work out ``padded`` once per name
        return F.flatten(
            F.transform(
                F.array(padded),
                lambda p: F.transform(
                    F.sequence(F.lit(1), F.size(p) - (q - 1)),
                    lambda i: F.struct(F.lit(q).alias("q"), F.array_join(F.slice(p, i, q), "").alias("gram")),
                ),
            )
        )

    singles = F.transform("chars", lambda c: F.struct(F.lit(1).alias("q"), c.alias("gram")))
    longer = [grams(q) for q in GRAM_SIZES if q > 1]
    return (
        split.select(name, "size", F.explode(F.concat(singles, *longer)).alias("g"))
        .groupBy(name, "size", F.col("g.q").alias("q"), F.col("g.gram").alias("gram"))
        .agg(F.count(F.lit(1)).cast("int").alias("n"))
        .select(name, "size", "q", "gram", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("nth"))
    )


def _shared_at_least(s: Column, total: Column, q: Column) -> Column:
    """Grams that two strings of ``total`` characters share at similarity >= s.

    With d <= (1-s)*total and L >= s*total/2; 0 where the bound says nothing.
    """
    slope = s / 2 - (q - 1) * (1 - s)
    return F.when((q == 1) | (slope > 0), total * slope + (q - 1)).otherwise(0.0)


def best_matches(scored: DataFrame, limit: int) -> DataFrame:
    """Top ``limit`` right names per left name; ties go to the smaller name."""
    if limit == 1:
        best = scored.groupBy("left_name").agg(
            F.min(F.struct((-F.col("score")).alias("minus"), F.col("right_name"))).alias("b")
        )
        return best.select(
            "left_name", F.col("b.right_name").alias("right_name"), (-F.col("b.minus")).alias("score")
        )
    # Spark applies the limit before the shuffle as well (WindowGroupLimit)
    order = Window.partitionBy("left_name").orderBy(F.desc("score"), "right_name")
    return (
        scored.withColumn("_pos", F.row_number().over(order)).filter(F.col("_pos") <= limit).drop("_pos")
    )


def _scored(pairs: DataFrame) -> DataFrame:
    return pairs.select(
        "left_name", "right_name", indel_ratio(F.col("left_name"), F.col("right_name")).alias("score")
    )


def _by_grams(open_names: DataFrame, rights: DataFrame, limit: int, score_cutoff: float, probe_rows: int, pair_budget: int) -> DataFrame:
    """(left_name, right_name) of all pairs that can be among the ``limit`` best, by prefixes of grams."""
    gram = ["q", "gram", "nth"]
    right_grams = land(_grams(fan_out(rights, "right_name"), "right_name").withColumnRenamed("size", "right_size"), "right-grams")
    frequency = key_sizes(right_grams, gram)
    rarest = Window.partitionBy("left_name", "q").orderBy("rows_per_key", "gram", "nth")
    left_grams = land(
        _grams(fan_out(open_names, "left_name"), "left_name")
        .join(frequency, gram, "left")
        .withColumn("rows_per_key", F.coalesce("rows_per_key", F.lit(0)))
        .withColumn("place", F.row_number().over(rarest))
        .withColumn("reach", F.sum("rows_per_key").over(rarest.rowsBetween(Window.unboundedPreceding, 0))),
        "left-grams",
    )

    # the longest grams that any right name shares, rarest first: up to ``probe_rows`` index rows per name, and at
    # least the rarest gram, of which at most ``probe_rows`` index rows are looked at. Any of them gives a lower bound
    probes = (
        left_grams.filter((F.col("q") > 1) & (F.col("rows_per_key") > 0))
        .filter((F.col("reach") <= probe_rows) | (F.col("reach") == F.col("rows_per_key")))
        .withColumn("longest", F.max("q").over(Window.partitionBy("left_name")))
        .filter(F.col("q") == F.col("longest"))
    )
    some = Window.partitionBy(*gram).orderBy("right_name")
    probed_rows = (
        right_grams.filter(F.col("q") > 1).withColumn("_nth_row", F.row_number().over(some)).filter(F.col("_nth_row") <= probe_rows)
    )
    probed = _scored(fan_out(probes, *gram).join(probed_rows, gram).select("left_name", "right_name").distinct())
    floor = F.lit(score_cutoff / 100.0)
    known = (
        best_matches(probed, limit)
        .groupBy("left_name")
        .agg(F.min("score").alias("weakest"), F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= limit)
        .select("left_name", (F.col("weakest") / 100.0).alias("s"))
    )
    bounds = open_names.join(known, "left_name", "left").select(
        "left_name", F.greatest(F.coalesce("s", F.lit(0.0)), floor).alias("s")
    )

    # how many grams, rarest first, must be looked up; the gram length with
    # fewer index rows to visit wins
    least_total = F.col("size") * 2 / (2 - F.col("s"))
    needed = F.greatest(
        F.ceil(_shared_at_least(F.col("s"), least_total, F.col("q")) - _SLACK),
        F.when(F.col("q") == 1, 1).otherwise(0),
    )
    sized = left_grams.join(bounds, "left_name").withColumn("needed", needed)
    width = F.col("size") + F.col("q") - 1
    prefix = sized.filter((F.col("needed") >= 1) & (F.col("place") <= width - F.col("needed") + 1))
    # windows over the grams of one name: as many rows as it has characters
    lookups = (
        prefix.withColumn("visits", F.max("reach").over(Window.partitionBy("left_name", "q")))
        .withColumn("least", F.min(F.struct("visits", "q")).over(Window.partitionBy("left_name")))
        .filter(F.col("q") == F.col("least.q"))
        .select(*gram, "left_name", F.col("size").alias("left_size"), "s", "needed")
    )
    met = spread_join(
        lookups, right_grams, gram, pair_budget, right_sizes=frequency
    ).filter(
        2 * F.least("left_size", "right_size") >= F.col("s") * (F.col("left_size") + F.col("right_size")) - _SLACK
    )
    # the other columns follow from the two names
    rest = ["q", "left_size", "right_size", "s", "needed"]
    shared = met.groupBy("left_name", "right_name").agg(
        F.count(F.lit(1)).alias("seen"), *[F.any_value(c).alias(c) for c in rest]
    )
    total = F.col("left_size") + F.col("right_size")
    possible = F.col("seen") + F.col("needed") - 1
    return shared.filter(
        possible >= _shared_at_least(F.col("s"), total, F.col("q")) - _SLACK
    )


def nearest_names(
    left: DataFrame,
    right: DataFrame,
    left_name: str,
    right_name: str,
    limit: int = 1,
    score_cutoff: float = 0.0,
    probe_rows: int = 64,
    pair_budget: int = PAIR_BUDGET,
    grid_pairs: int = GRID_PAIRS,
    blocks: tuple[int, int] = (LEFT_BLOCK, RIGHT_BLOCK),
) -> DataFrame:
    """(left_name, right_name, score): the ``limit`` best distinct right names.

    ``score_cutoff`` (0..100) drops weaker matches; at 0 every left name gets
    ``limit`` of them, as long as there are that many right names. Up to ``grid_pairs``
    pairs of names blocks (of as many left and right names as ``blocks`` says) are compared as wholes, beyond by an index of grams;
    ``probe_rows`` (index rows looked at per name) steers only its step 2. None of them changes the
    result. The function starts jobs.
    """
    lefts = land(left.select(F.col(left_name).alias("left_name")).filter("left_name is not null").distinct(), "left-names")
    rights = land(right.select(F.col(right_name).alias("right_name")).filter("right_name is not null").distinct(), "right-names")

    equal = lefts.join(rights, F.col("left_name") == F.col("right_name"), "left_semi").select(
        "left_name", F.col("left_name").alias("right_name"), F.lit(100.0).alias("score")
    )
    if limit == 1:
        open_names = lefts.join(rights, F.col("left_name") == F.col("right_name"), "left_anti")
    else:
        open_names = lefts

    n_lefts, n_rights = lefts.count(), rights.count()
    if n_lefts * n_rights <= grid_pairs:
        found = nearest_by_grid(open_names, rights, n_lefts, n_rights, limit, score_cutoff, *blocks)
    else:
        found = _scored(_by_grams(open_names, rights, limit, score_cutoff, probe_rows, pair_budget))
        if limit > 1:
            # two empty names are equal, but have no gram that says so
            found = found.filter("left_name <> '' or right_name <> ''").unionByName(equal.filter("left_name = ''"))
    if limit == 1:
        found = found.unionByName(equal)
    best = best_matches(found.filter(F.col("score") >= score_cutoff), limit)
    if score_cutoff > 0:
        return best
    # names sharing no character with enough right names: similarity 0 to
    # the rest, so the smallest names fill up; at most 2 * limit of them
    # can be needed
    best = land(best, "best-names")
    filler = (
        rights.orderBy("right_name").limit(2 * limit).agg(F.collect_list("right_name").alias("fill")).scalar()
    )
    filled = best.groupBy("left_name").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= limit)
    short = lefts.join(filled, "left_name", "left_anti")
    padding = short.withColumn("fill", filler).select("left_name", F.explode("fill").alias("right_name"))
    if limit > 1:
        padding = padding.join(best, ["left_name", "right_name"], "left_anti")
    return best_matches(best.unionByName(_scored(padding)), limit)


def fuzzy_merge(
    left: DataFrame,
    right: DataFrame,
    left_id: str,
    right_id: str,
    left_name: str = "name",
    right_name: str = "name",
    limit: int = 1,
    score_cutoff: float = 0.0,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """The ``limit`` best right rows of every left row.

    Every right row of a name counts: of equally good ones the smaller name goes
    first, then the smaller id. Columns: df_left_id, df_right_id, name_df_left,
    name_df_right, match_score, then the ``carry`` columns of the right row.
    """
    names = nearest_names(left, right, left_name, right_name, limit, score_cutoff)
    # a name is held by any number of rows, but no left row takes more than ``limit`` of them
    holders = right.select(F.col(right_name).alias("right_name"), F.col(right_id).alias("_right_id"), *carry)
    first = Window.partitionBy("right_name").orderBy("_right_id")
    holders = holders.withColumn("_holder", F.row_number().over(first)).filter(F.col("_holder") <= limit).drop("_holder")
    order = Window.partitionBy("left_name").orderBy(F.desc("score"), "right_name", "_right_id")
    matched = names.join(holders, "right_name").withColumn("_pos", F.row_number().over(order)).filter(F.col("_pos") <= limit)
    rows = left.select(F.col(left_id).alias("df_left_id"), F.col(left_name).alias("left_name"))
    return rows.join(matched, "left_name").select(
        "df_left_id",
        F.col("_right_id").alias("df_right_id"),
        F.col("left_name").alias("name_df_left"),
        F.col("right_name").alias("name_df_right"),
        F.col("score").alias("match_score"),
        *carry,
    )
