"""Title normalisers. All are column expressions inside whole-stage codegen.

The rank normaliser reads its own intermediate results several times; it is
therefore a run of projections rather than one nested expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.functions.text import after, before, bracketed, has, strip, without

# Wordings of titles
ON_LEAVE = "Minister on Leave"
LEAVE_REASON = "Maternity leave"
INTERIM = "Interim"
COVER = "(maternity cover)"
JOINT = " – joint with "
JOINT_PATTERN = r"(?U)\s\S\sjoint with\s\w*(\sand\s\w*)*"
EQUALITIES = ", and Minister for Equalities"
# first hit only; text, replacement
LORDS_FORMS = (
    (" (Minister for the Lords)", ""),
    (" (Lords Minister for", " (Minister for"),
    (" (Lords Minister)", ""),
    (" and DCMS Lords Minister", ""),
    (", and Lords Minister", ""),
    (" and Lords Minister", ""),
)
MOS = "Minister of State"
PUSS = "Parliamentary Under-Secretary of State"
PARLIAMENTARY_SECRETARY = "Parliamentary Secretary"
CHIEF_WHIP = "Parliamentary Secretary to the Treasury (Chief Whip)"
MINISTER_FOR = "Minister for "
CABINET_OFFICE = "Minister of State for Cabinet Office"


def replace_ampersand(title: Column) -> Column:
    return without(title, "&", "and")


def on_leave(title: Column) -> Column:
    return has(title, ON_LEAVE)


def leave_unreadable(title: Column) -> Column:
    """A leave title that does not name the post in brackets: for a person to look at."""
    return on_leave(title) & ~has(title, "(")


def leave_title(title: Column) -> Column:
    """The post in brackets of a leave title; kept as it is where there are none."""
    return F.when(on_leave(title), F.coalesce(bracketed(title), title)).otherwise(title)


def is_acting(title: Column) -> Column:
    return has(title, INTERIM) | has(title, COVER)


def acting_title(title: Column) -> Column:
    return (
        F.when(has(title, INTERIM), without(title, INTERIM + " "))
        .when(has(title, COVER), without(title, " " + COVER))
        .otherwise(title)
    )


def leave_and_acting(df: DataFrame, title: str) -> DataFrame:
    """Rewrite ``title``; set is_on_leave, is_acting, leave_reason, title_unreadable."""
    kept = [c for c in df.columns if c not in {"is_on_leave", "is_acting", "leave_reason", "title_unreadable"}]
    raw = F.col(title)
    first = df.select(
        *[c for c in kept if c != title],
        leave_title(raw).alias(title),
        on_leave(raw).alias("is_on_leave"),
        F.when(on_leave(raw), LEAVE_REASON).alias("leave_reason"),
        leave_unreadable(raw).alias("title_unreadable"),
    )
    return first.withColumns({"is_acting": is_acting(raw), title: acting_title(raw)})


def drop_joint(title: Column) -> Column:
    return F.when(has(title, JOINT), F.regexp_replace(title, JOINT_PATTERN, "")).otherwise(title)


def drop_equalities(title: Column) -> Column:
    return without(title, EQUALITIES)


def drop_lords(title: Column) -> Column:
    chain = F
    for text, put in LORDS_FORMS:
        chain = chain.when(has(title, text), without(title, text, put))
    return chain.otherwise(title)


def hyphenate_under_secretary(title: Column) -> Column:
    return without(title, "Under Secretary", "Under-Secretary")


def standardise_rank(df: DataFrame, title: str, rank: str, fix_known_defects: bool = False) -> DataFrame:
    """Bring ministerial titles to "Minister for ..." and read off the rank.

    ``fix_known_defects`` avoids "Minister for Minister for ..." from the comma
    form and the doubled blank of one bracket form; off, results are as the
    established data has them.
    """
    columns = [c for c in df.columns if c not in {title, rank}]
    t = F.col(title)
    ranked = has(t, MOS) | has(t, PARLIAMENTARY_SECRETARY) | has(t, PUSS)
    secretary = has(t, PARLIAMENTARY_SECRETARY)

    # the forms that are final at once, and the rank of the others
    settled = (
        F.when(secretary & has(t, CHIEF_WHIP), F.lit("Chief Whip"))
        .when(
            secretary & has(t, PARLIAMENTARY_SECRETARY + " (Minister for "),
            F.concat(F.lit(MINISTER_FOR), strip(F.rtrim(after(t, "(" + MINISTER_FOR), F.lit(")")))),
        )
        .when(
            secretary & has(t, PARLIAMENTARY_SECRETARY + " for "),
            F.concat(F.lit(MINISTER_FOR), strip(after(t, PARLIAMENTARY_SECRETARY + " for "))),
        )
        .when(~F.coalesce(ranked, F.lit(False)), t)
    )
    rank_of = (
        F.when(secretary & has(t, CHIEF_WHIP), "Parl. lead.")
        .when(has(t, PUSS) | secretary, "PUSS")
        .when(has(t, MOS), "MoS")
    )
    staged = df.withColumn(title, hyphenate_under_secretary(t)).select(
        *columns, title, settled.alias("_settled"), rank_of.alias(rank)
    )

    def step(frame: DataFrame, change: Column) -> DataFrame:
        return frame.withColumn(title, change)

    staged = step(staged, before(t, " at the "))
    other_office = "Minister for the Cabinet Office ("
    joined = MINISTER_FOR if not fix_known_defects else MINISTER_FOR.rstrip()
    staged = step(
        staged,
        F.when(t == CABINET_OFFICE, F.lit(MOS))
        .when(has(t, CABINET_OFFICE + " ("), without(without(t, CABINET_OFFICE + " (", MINISTER_FOR), ")"))
        .when(
            has(t, other_office + "Minister for"), without(without(t, other_office + "Minister for", joined), ")")
        )
        .when(has(t, other_office), without(without(t, other_office, MINISTER_FOR), ")"))
        .otherwise(t),
    )
    staged = step(
        staged,
        F.when(
            has(t, MOS + " for "), F.concat(F.lit(MINISTER_FOR), after(t, MOS + " for "))
        ).otherwise(t),
    )
    staged = step(staged, F.when(has(t, PUSS + " and "), after(t, "and ")).otherwise(t))
    staged = step(
        staged, F.when(has(t, PUSS + " for "), F.concat(F.lit(MINISTER_FOR), after(t, "for "))).otherwise(t)
    )
    topic = after(t, ", ")
    if fix_known_defects:
        comma = F.when(topic.startswith(MINISTER_FOR), topic).otherwise(F.concat(F.lit(MINISTER_FOR), topic))
    else:
        comma = F.concat(F.lit(MINISTER_FOR), topic)
    staged = step(staged, F.when(has(t, PUSS + ", "), comma).otherwise(t))
    staged = step(
        staged,
        F.when(has(t, "(Minister"), bracketed(t))
        .when(has(t, "(") & ~has(t, MINISTER_FOR.rstrip()), F.concat(F.lit(MINISTER_FOR), bracketed(t)))
        .otherwise(t),
    )
    return staged.withColumn(title, F.coalesce("_settled", strip(t))).select(*columns, title, rank)


def normalise_titles(
    df: DataFrame, title: str = "post_name_clean", rank: str = "post_rank", fix_known_defects: bool = False
) -> DataFrame:
    """The whole chain, in its fixed order; adds the flag ``title_unreadable``."""
    t = F.col(title)
    step = leave_and_acting(df.withColumn(title, replace_ampersand(t)), title)
    step = step.withColumn(title, drop_joint(t))
    step = step.withColumn(title, drop_equalities(t))
    step = step.withColumn(title, drop_lords(t))
    return standardise_rank(step, title, rank, fix_known_defects)
