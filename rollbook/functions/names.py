"""Names of people and topics of posts. Both rules are this library's own definition."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollbook.functions.fixed_rules import RESERVED_TOPICS
from rollbook.functions.text import bind, strip

HONORIFICS = ("The", "Rt", "Right", "Hon", "Honourable", "Mr", "Mrs", "Ms", "Miss", "Dr", "Prof", "Professor", "Sir", "Dame")
POST_NOMINALS = ("MP", "MS", "MSP", "MLA", "QC", "KC", "CBE", "OBE", "MBE", "DBE", "KBE", "CB", "CH", "PC", "JP", "DL", "VC", "GCMG", "KCMG")
PEERAGE = ("Lord", "Lady", "Baroness", "Baron", "Viscount", "Viscountess", "Earl", "Countess", "Duke", "Duchess")


def strip_name_affixes(
    name: Column,
    exclude_peerage: bool = True,
    honorifics: Sequence[str] = HONORIFICS,
    post_nominals: Sequence[str] = POST_NOMINALS,
    peerage: Sequence[str] = PEERAGE,
) -> Column:
    """Drop honorifics before a name and letters after it, as often as they occur.

    ``exclude_peerage`` keeps Lord, Baroness and the like.
    """
    lead = list(honorifics) + ([] if exclude_peerage else list(peerage))
    heads = "|".join(re.escape(w) for w in lead)
    tails = "|".join(re.escape(w) for w in post_nominals)
    headless = F.regexp_replace(name, rf"(?U)^\s*(?:(?:{heads})\.?\s+)+", "")
    return strip(F.regexp_replace(headless, rf"(?U)(?:,?\s+(?:{tails})\.?)+\s*\z", ""))


# leads of a title, also of a further one joined to it
_LEAD = r"(?:Minister of State for|Minister for|Minister of|Secretary of State for)"


def post_topic(title: Column, reserved: Sequence[str] = RESERVED_TOPICS) -> Column:
    """What a post is about: the title without its leads and any bracket.

    "Minister for X (Y)" gives X, "Minister for X and Minister for Y" gives "X and Y". Reserved phrases that the
    title has and the topic would lose are the topic instead, the longest first; a phrase within a longer one
    does not count.
    """
    led = F.regexp_replace(title, rf"(?U)^\s*{_LEAD}\s+", "")
    joined = F.regexp_replace(led, rf"(?U)(,?\s+and|,)\s+{_LEAD}\s+", "$1 ")
    plain = strip(F.regexp_replace(joined, r"(?U)\s*\([^)]*\)?", ""))
    phrases = sorted(reserved, key=len, reverse=True)
    if not phrases:
        return plain

    def chosen(lost: Column) -> Column:
        whole = F.filter(lost, lambda p: ~F.exists(lost, lambda q: (q != p) & q.contains(p)))
        return F.when(F.size(lost) > 0, F.array_join(whole, " and ")).otherwise(plain)

    return bind(F.filter(F.array(*map(F.lit, phrases)), lambda p: title.contains(p) & ~plain.contains(p)), chosen)
