"""Ordered rule tables as one column expression: the first rule that fires wins.

Rules read only raw columns, never each other's output, so any number of rule
tables go into a single projection.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# which column each condition of a rule reads
RULE_COLUMNS = {
    "titles": "post_name",
    "persons": "person_name",
    "organisations": "organisation_name",
    "short_names": "organisation_short_name",
}


@dataclass(frozen=True)
class Rule:
    result: str
    titles: tuple[str, ...] | None = None
    persons: tuple[str, ...] | None = None
    organisations: tuple[str, ...] | None = None
    short_names: tuple[str, ...] | None = None
    no_organisation: bool = False

    def condition(self, collation: str | None = None) -> Column:
        """Trailing blanks of the rule's own values do not count."""
        tests = []
        for field, column in RULE_COLUMNS.items():
            values = getattr(self, field)
            if values is not None:
                subject = F.collate(F.col(column), collation) if collation else F.col(column)
                tests.append(subject.isin(*[v.rstrip(" ") for v in values]))
        if self.no_organisation:
            tests.append(F.col(RULE_COLUMNS["organisations"]).isNull())
        return reduce(lambda a, b: a & b, tests)


def exact(title: str, result: str, persons: tuple[str, ...] | None = None) -> Rule:
    return Rule(result, titles=(title,), persons=persons)


def first_match(rules: Sequence[Rule], otherwise: Column, collation: str | None = None) -> Column:
    chain = F
    for rule in rules:
        chain = chain.when(rule.condition(collation), F.lit(rule.result))
    return chain.otherwise(otherwise)


def house_to_kind(house: Column) -> Column:
    """MP or Peer by house; null for any other."""
    return F.when(house == "Commons", "MP").when(house == "Lords", "Peer")


def preferred_rank(listed: Column, own: Column) -> Column:
    return F.coalesce(listed, own)


def seniority_group(rank: Column) -> Column:
    return F.when(rank.isin("MoS", "PUSS"), "MoS/PUSS").otherwise(rank)
