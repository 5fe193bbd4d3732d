"""The title, organisation and short-name tables, in rule order.

These must hold exactly these texts for results to agree; nothing here is
derived. A rule fires when all of its conditions hold; the first rule wins.
"""

from __future__ import annotations

from rollbook.functions.rules import Rule, exact

# --- post_name_clean -------------------------------------------------------

POST_NAME_RULES: tuple[Rule, ...] = (
    # capitalisation
    exact("Parliamentary Under Secretary of State for natural environment and science",
          "Parliamentary Under Secretary of State for Natural Environment and Science"),
    exact("Parliamentary Under Secretary of State for water, forestry, rural affairs and resource management",
          "Parliamentary Under Secretary of State for Water, Forestry, Rural Affairs and Resource Management"),
    exact("Parliamentary Under Secretary of State for farming, food and marine environment",
          "Parliamentary Under Secretary of State for Farming, Food and Marine Environment"),
    # department named in the title
    exact("Secretary of State for Ministry of Housing, Communities & Local Government",
          "Secretary of State for Housing, Communities & Local Government"),
    exact("Parliamentary Under Secretary of State for BIS and DCMS and Minister for Intellectual Property",
          "Minister for Intellectual Property"),
    exact("Parliamentary Under Secretary of State for Business, Innovation and Skills and Minister for Intellectual Property",
          "Minister for Intellectual Property"),
    # whips
    exact("Assistant Government Whip", "Assistant Whip (HM Treasury)"),
    exact("Assistant Whip, House of Commons", "Assistant Whip (HM Treasury)"),
    exact("Baroness in Waiting (Government Whip)", "Baroness in Waiting"),
    exact("Minister (Baroness in Waiting)", "Baroness in Waiting"),
    exact("Spokesman and Whip in the House of Lords, Baroness in Waiting", "Baroness in Waiting"),
    exact("Parliamentary Secretary to the Treasury (Chief Whip)",
          "Chief Whip and Parliamentary Secretary to the Treasury"),
    exact("Comptroller of HM Household (Government Whip)", "Comptroller of HM Household (Senior Whip)"),
    exact("Government Whip, Comptroller of HM Household", "Comptroller of HM Household (Senior Whip)"),
    exact("Deputy Chief Whip, Comptroller of HM Household", "Comptroller of HM Household (Senior Whip)"),
    exact("Government Whip (Lord Commissioner of HM Treasury)", "Lord Commissioner (Whip)"),
    exact("Government Whip, Lord Commissioner of HM Treasury", "Lord Commissioner (Whip)"),
    exact("Junior Lord of the Treasury (Government Whip)", "Lord Commissioner (Whip)"),
    exact("Government Whip", "Lord Commissioner (Whip)", persons=("Douglas Ross MP",)),
    exact("Lord in Waiting (Government Whip)", "Lord in Waiting"),
    exact("Government Whip, Vice Chamberlain of HM Household", "Vice Chamberlain of HM Household (Senior Whip)"),
    exact("Vice Chamberlain of HM Household (Government Whip)", "Vice Chamberlain of HM Household (Senior Whip)"),
    # joint roles
    exact("Parliamentary Secretary (Minister for Defence People and Veterans)",
          "Minister for Defence People and Veterans"),
    exact("Parliamentary Secretary (Minister for Equalities)", "Minister for Equalities"),
    # others
    exact("Economic Secretary to the Treasury", "Economic Secretary"),
    exact("Exchequer Secretary to the Treasury", "Exchequer Secretary"),
    exact("Financial Secretary to the Treasury", "Financial Secretary"),
    exact("Commercial Secretary to the Treasury", "Commercial Secretary"),
    exact("Commercial Secretary to the Treasury - Minister of State", "Commercial Secretary"),
    exact("Lord Chancellor and Secretary of State for Justice", "Secretary of State for Justice and Lord Chancellor"),
    exact("HM Advocate General for Scotland", "Advocate General for Scotland"),
    exact("Parliamentary Under Secretary of State (Minister for Lords)", "Parliamentary Under-Secretary of State"),
    exact("Parliamentary Under Secretary of State", "Parliamentary Under-Secretary of State"),
    exact("Parliamentary Secretary of State (Deputy Leader of the House of Commons)",
          "Deputy Leader of the House of Commons"),
    exact("UK Government Minister for Wales", "Parliamentary Under-Secretary of State",
          persons=("Alun Cairns MP", "Stephen Crabb MP", "Guto Bebb", "David Jones MP")),
    exact("Secretary of State for Business, Innovation and Skills and President of the Board of Trade",
          "Secretary of State for Business, Innovation and Skills"),
    exact("Secretary of State for Communities and Local Government",
          "Secretary of State for Communities and Local Government"),
)

# --- titles of whips -------------------------------------------------------

COMMONS_WHIP_TITLES = (
    "Assistant Government Whip",
    "Assistant Whip",
    "Comptroller of HM Household (Government Whip) ",
    "Deputy Chief Whip, Comptroller of HM Household",
    "Government Whip",
    "Government Whip, Comptroller of HM Household",
    "Government Whip (Lord Commissioner of HM Treasury)",
    "Government Whip, Lord Commissioner of HM Treasury",
    "Government Whip, Vice Chamberlain of HM Household",
    "Junior Lord of the Treasury (Government Whip)",
    "Parliamentary Secretary to the Treasury (Chief Whip)",
    "Treasurer of HM Household (Deputy Chief Whip)",
    "Vice Chamberlain of HM Household (Government Whip)",
)
LORDS_WHIP_TITLES = (
    "Baroness in Waiting (Government Whip)",
    "Captain of the Honourable Corps of Gentlemen at Arms (Lords Chief Whip)",
    "Captain of the King's Bodyguard of the Yeomen of the Guard (Lords Deputy Chief Whip)",
    "Lord in Waiting (Government Whip) ",
    "Lord in Waiting",
    "Spokesman and Whip in the House of Lords, Baroness in Waiting",
)

# --- rows without an organisation: title, persons, name, short name -------

MISSING_ORGANISATION = (
    ("Minister of State", ("Lord Howell of Guildford",),
     "Foreign, Commonwealth & Development Office", "FCDO"),
    ("Minister on Leave (Secretary of State)", ("Michelle Donelan MP",),
     "Department for Science, Innovation and Technology", "DSIT"),
    ("Minister on Leave (Minister of State)", ("Julia Lopez MP",),
     "Department for Culture, Media and Sport", "DCMS"),
    ("Minister on Leave (Parliamentary Under Secretary of State)", ("Baroness Penn",),
     "Department for Levelling Up, Housing and Communities", "DLUHC"),
    ("Parliamentary Under Secretary of State", ("Nick Hurd",),
     "Department for International Development", "DfID"),
    ("Parliamentary Under Secretary of State for Sport and Civil Society", ("Helen Grant MP", "Tracey Crouch MP"),
     "Department for Culture, Media and Sport", "DCMS"),
    ("Parliamentary Under Secretary of State for Women and Equalities", ("Lynne Featherstone",),
     "Department for Culture, Media and Sport", "DCMS"),
    ("Parliamentary Under Secretary of State for Women and Equalities", ("Helen Grant MP",),
     "Department for Culture, Media and Sport", "DCMS"),
    ("Minister for Women and Equalities", None,
     "Government Equalities Office", "GEO"),
)

# --- organisation_name_clean: whips, then rows without an organisation ----

ORGANISATION_NAME_RULES: tuple[Rule, ...] = (
    Rule("Government Whips-House of Commons", titles=COMMONS_WHIP_TITLES),
    Rule("Government Whips-House of Lords", titles=LORDS_WHIP_TITLES),
    *(Rule(name, titles=(title,), persons=persons, no_organisation=True)
      for title, persons, name, _ in MISSING_ORGANISATION),
)

# --- organisation_short_name_clean: organisations, whips, then rows without one

ORGANISATION_SHORT_NAME_RULES: tuple[Rule, ...] = (
    Rule("CO", organisations=("Cabinet Office",)),
    Rule("DCMS", organisations=("Department for Digital, Culture, Media & Sport",)),
    Rule("DPM", organisations=("Deputy Prime Minister's Office",)),
    Rule("HO", organisations=("Home Office",)),
    Rule("Leader Commons", organisations=("Office of the Leader of the House of Commons",)),
    Rule("Leader Lords", organisations=("Office of the Leader of the House of Lords",)),
    Rule("PM", organisations=("Prime Minister's Office, 10 Downing Street",)),
    Rule("Scot", organisations=("Office of the Secretary of State for Scotland",)),
    Rule("Wal", organisations=("Office of the Secretary of State for Wales",)),
    Rule("DfID", short_names=("DFID",)),
    Rule("MoD", short_names=("MOD",)),
    Rule("MoJ", short_names=("MOJ",)),
    Rule("Whip Commons", titles=COMMONS_WHIP_TITLES),
    Rule("Whip Lords", titles=LORDS_WHIP_TITLES),
    *(Rule(short, titles=(title,), persons=persons, no_organisation=True)
      for title, persons, _, short in MISSING_ORGANISATION),
)

# --- filters of the cleaned table -----------------------------------------

KEPT_LOCALE = "en"
KEPT_DOCUMENT_TYPE = "ministerial_role"
DROPPED_TITLES = ("First Lord of the Treasury", "President of the Board of Trade")
DEPARTMENT_PREFIX = "d"
KEPT_ORGANISATIONS = (
    "Deputy Prime Minister's Office",
    "Government Equalities Office",
    "Prime Minister's Office, 10 Downing Street",
)
DROPPED_ORGANISATIONS = ("UK Export Finance", "UK Trade & Investment")

# --- titles for which several listed names per appointment are expected ----

MANY_NAMED_TITLES = (
    "Minister for Women",
    "Minister for Equalities",
    "Minister for Women and Equalities",
    "Minister of State for Women and Equalities",
    "Parliamentary Under Secretary of State for Women and Equalities",
)

# --- topics kept whole ------------------------------------------------------

RESERVED_TOPICS = (
    "Foreign and Commonwealth Office",
    "Safe and Legal Migration",
    "Violence Against Women and Girls",
    "Yorkshire and the Humber",
)
