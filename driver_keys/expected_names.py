"""What titles and organisations are to become, listed by outcome, for the SQL side of the rule queries.

The library holds the same facts as ordered rules; here they are plain lookup
tables without an order, as every title has one outcome.
"""

from __future__ import annotations

# cleaned title: the titles that become it, whoever holds them
TITLES = {
    "Parliamentary Under Secretary of State for Natural Environment and Science": ("Parliamentary Under Secretary of State for natural environment and science",),
    "Parliamentary Under Secretary of State for Water, Forestry, Rural Affairs and Resource Management": (
        "Parliamentary Under Secretary of State for water, forestry, rural affairs and resource management",
    ),
    "Parliamentary Under Secretary of State for Farming, Food and Marine Environment": ("Parliamentary Under Secretary of State for farming, food and marine environment",),
    "Secretary of State for Housing, Communities & Local Government": ("Secretary of State for Ministry of Housing, Communities & Local Government",),
    "Minister for Intellectual Property": (
        "Parliamentary Under Secretary of State for BIS and DCMS and Minister for Intellectual Property",
        "Parliamentary Under Secretary of State for Business, Innovation and Skills and Minister for Intellectual Property",
    ),
    "Assistant Whip (HM Treasury)": ("Assistant Government Whip", "Assistant Whip, House of Commons"),
    "Baroness in Waiting": ("Baroness in Waiting (Government Whip)", "Minister (Baroness in Waiting)", "Spokesman and Whip in the House of Lords, Baroness in Waiting"),
    "Chief Whip and Parliamentary Secretary to the Treasury": ("Parliamentary Secretary to the Treasury (Chief Whip)",),
    "Comptroller of HM Household (Senior Whip)": (
        "Comptroller of HM Household (Government Whip)", "Government Whip, Comptroller of HM Household", "Deputy Chief Whip, Comptroller of HM Household",
    ),
    "Lord Commissioner (Whip)": (
        "Government Whip (Lord Commissioner of HM Treasury)", "Government Whip, Lord Commissioner of HM Treasury", "Junior Lord of the Treasury (Government Whip)",
    ),
    "Lord in Waiting": ("Lord in Waiting (Government Whip)",),
    "Vice Chamberlain of HM Household (Senior Whip)": ("Government Whip, Vice Chamberlain of HM Household", "Vice Chamberlain of HM Household (Government Whip)"),
    "Minister for Defence People and Veterans": ("Parliamentary Secretary (Minister for Defence People and Veterans)",),
    "Minister for Equalities": ("Parliamentary Secretary (Minister for Equalities)",),
    "Economic Secretary": ("Economic Secretary to the Treasury",),
    "Exchequer Secretary": ("Exchequer Secretary to the Treasury",),
    "Financial Secretary": ("Financial Secretary to the Treasury",),
    "Commercial Secretary": ("Commercial Secretary to the Treasury", "Commercial Secretary to the Treasury - Minister of State"),
    "Secretary of State for Justice and Lord Chancellor": ("Lord Chancellor and Secretary of State for Justice",),
    "Advocate General for Scotland": ("HM Advocate General for Scotland",),
    "Parliamentary Under-Secretary of State": ("Parliamentary Under Secretary of State (Minister for Lords)", "Parliamentary Under Secretary of State"),
    "Deputy Leader of the House of Commons": ("Parliamentary Secretary of State (Deputy Leader of the House of Commons)",),
    "Secretary of State for Business, Innovation and Skills": ("Secretary of State for Business, Innovation and Skills and President of the Board of Trade",),
    "Secretary of State for Communities and Local Government": ("Secretary of State for Communities and Local Government",),
}

# (cleaned title, title): only if one of these people holds it
HELD_TITLES = {
    ("Lord Commissioner (Whip)", "Government Whip"): ("Douglas Ross MP",),
    ("Parliamentary Under-Secretary of State", "UK Government Minister for Wales"): ("Alun Cairns MP", "Stephen Crabb MP", "Guto Bebb", "David Jones MP"),
}

# (organisation, short name): titles that belong there whatever organisation is given
WHIPS = {
    ("Government Whips-House of Commons", "Whip Commons"): (
        "Assistant Government Whip", "Assistant Whip", "Comptroller of HM Household (Government Whip)", "Deputy Chief Whip, Comptroller of HM Household",
        "Government Whip", "Government Whip, Comptroller of HM Household", "Government Whip (Lord Commissioner of HM Treasury)",
        "Government Whip, Lord Commissioner of HM Treasury", "Government Whip, Vice Chamberlain of HM Household", "Junior Lord of the Treasury (Government Whip)",
        "Parliamentary Secretary to the Treasury (Chief Whip)", "Treasurer of HM Household (Deputy Chief Whip)", "Vice Chamberlain of HM Household (Government Whip)",
    ),
    ("Government Whips-House of Lords", "Whip Lords"): (
        "Baroness in Waiting (Government Whip)", "Captain of the Honourable Corps of Gentlemen at Arms (Lords Chief Whip)",
        "Captain of the King's Bodyguard of the Yeomen of the Guard (Lords Deputy Chief Whip)", "Lord in Waiting (Government Whip)", "Lord in Waiting",
        "Spokesman and Whip in the House of Lords, Baroness in Waiting",
    ),
}

# (organisation, short name): (title, person) pairs that belong there if no organisation is given; None is anybody
WITHOUT_ORGANISATION = {
    ("Foreign, Commonwealth & Development Office", "FCDO"): (("Minister of State", "Lord Howell of Guildford"),),
    ("Department for Science, Innovation and Technology", "DSIT"): (("Minister on Leave (Secretary of State)", "Michelle Donelan MP"),),
    ("Department for Culture, Media and Sport", "DCMS"): (
        ("Minister on Leave (Minister of State)", "Julia Lopez MP"),
        ("Parliamentary Under Secretary of State for Sport and Civil Society", "Helen Grant MP"),
        ("Parliamentary Under Secretary of State for Sport and Civil Society", "Tracey Crouch MP"),
        ("Parliamentary Under Secretary of State for Women and Equalities", "Lynne Featherstone"),
        ("Parliamentary Under Secretary of State for Women and Equalities", "Helen Grant MP"),
    ),
    ("Department for Levelling Up, Housing and Communities", "DLUHC"): (("Minister on Leave (Parliamentary Under Secretary of State)", "Baroness Penn"),),
    ("Department for International Development", "DfID"): (("Parliamentary Under Secretary of State", "Nick Hurd"),),
    ("Government Equalities Office", "GEO"): (("Minister for Women and Equalities", None),),
}

# short names by organisation, and by another way to write the short name
SHORT_NAMES = {
    "CO": "Cabinet Office", "DCMS": "Department for Digital, Culture, Media & Sport", "DPM": "Deputy Prime Minister's Office", "HO": "Home Office",
    "Leader Commons": "Office of the Leader of the House of Commons", "Leader Lords": "Office of the Leader of the House of Lords",
    "PM": "Prime Minister's Office, 10 Downing Street", "Scot": "Office of the Secretary of State for Scotland", "Wal": "Office of the Secretary of State for Wales",
}
REWRITTEN = {"DfID": "DFID", "MoD": "MOD", "MoJ": "MOJ"}

UNTOUCHED_TITLES = ("Minister for Care", "Government Whip (Lords)", "Lord Commissioner (Whip)")
UNTOUCHED_PEOPLE = ("Other Person",)
UNTOUCHED_ORGANISATIONS = ("Home Office ", "Ministry of Defence")


def quoted(text: str | None) -> str:
    return "cast(null as varchar(200))" if text is None else "'" + text.replace("'", "''") + "'"


def rows_of(rows, *columns: str) -> str:
    """A relation of constant rows, numbered by ``n`` from 0, for both SQL engines."""
    lines = ", ".join(f"({n}, {', '.join(map(quoted, row))})" for n, row in enumerate(rows))
    return f"(select * from (values {lines}) as t(n, {', '.join(columns)}))"


def all_titles() -> list[str]:
    listed = [t for titles in TITLES.values() for t in titles] + [t for _, t in HELD_TITLES] + [t for titles in WHIPS.values() for t in titles]
    listed += [t for pairs in WITHOUT_ORGANISATION.values() for t, _ in pairs]
    return [*dict.fromkeys(listed), *UNTOUCHED_TITLES]


def all_people() -> list[str]:
    people = [p for held in HELD_TITLES.values() for p in held] + [p for pairs in WITHOUT_ORGANISATION.values() for _, p in pairs if p]
    return [*dict.fromkeys(people), *UNTOUCHED_PEOPLE]


def all_organisations() -> list[tuple[str | None, str | None]]:
    """(organisation, short name) as given."""
    named = [(name, None) for name in SHORT_NAMES.values()] + [("Some Office", written) for written in REWRITTEN.values()]
    return [*named, (None, None), (None, "MOD"), *((name, "ABC") for name in UNTOUCHED_ORGANISATIONS)]


CLEAN_TITLES = rows_of([(t, clean) for clean, titles in TITLES.items() for t in titles], "title", "clean")
CLEAN_HELD = rows_of([(t, p, clean) for (clean, t), people in HELD_TITLES.items() for p in people], "title", "person", "clean")
WHIP_TITLES = rows_of([(t, name, short) for (name, short), titles in WHIPS.items() for t in titles], "title", "name", "short")
GIVEN_OFFICE = rows_of([(t, p, name, short) for (name, short), pairs in WITHOUT_ORGANISATION.items() for t, p in pairs], "title", "person", "name", "short")
SHORT_BY_NAME = rows_of([(name, short) for short, name in SHORT_NAMES.items()], "name", "short")
SHORT_BY_SHORT = rows_of([(written, short) for short, written in REWRITTEN.items()], "written", "short")
