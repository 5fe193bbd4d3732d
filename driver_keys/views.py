"""Test views over the driver's tables, as SQL that Spark and DuckDB both run.

A name in braces is a driver table or another view. Suffix ``_core``: the own
database; ``_ext``: the external listing.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from driver_keys.expected_names import all_organisations, all_people, all_titles, rows_of
from rollbook.session import land

VIEWS: dict[str, str] = {}

VIEWS["v_person"] = """
select c_custkey as id, c_name as name, cast(null as date) as start_date,
 case when c_custkey % 7 = 0 then date '1998-01-01' end as end_date from {customer}
union all
select c_custkey, concat(c_name, ' B'), date '1998-01-01', cast(null as date) from {customer} where c_custkey % 7 = 0"""

VIEWS["v_org"] = """
select n_nationkey as id, n_name as short_name,
 case when n_nationkey % 5 <> 0 then date '1990-01-01' end as start_date,
 case when n_nationkey % 4 = 1 then date '1998-01-01' end as end_date from {nation}
union all
select n_nationkey + 100, n_name, date '1998-01-01', cast(null as date) from {nation} where n_nationkey % 4 = 1"""

VIEWS["v_post"] = """
select p_partkey as id, cast(p_partkey % 25 as int) as organisation_id, concat('Minister for ', p_name) as name,
 case p_size % 3 when 0 then 'MoS' when 1 then 'PUSS' else 'SoS' end as rank_equivalence from {part}"""

VIEWS["v_appt"] = """
select o_orderkey as id, o_custkey as person_id, o_orderkey % (select count(*) from {part}) as post_id,
 cast(o_orderdate as date) as start_date,
 case when o_orderkey % 6 <> 0 then cast(o_orderdate as date) + cast(o_orderkey % 400 as int) end as end_date
from {orders}"""

VIEWS["v_spell"] = """
select id as appointment_id, start_date,
 case when id % 4 = 0 and end_date > start_date + 10 then start_date + 10 else end_date end as end_date,
 case when id % 9 = 0 then 'Attends cabinet' else 'Non-cabinet' end as cabinet_status,
 id % 13 = 0 as is_on_leave, id % 17 = 0 as is_acting,
 case when id % 13 = 0 then 'Maternity leave' end as leave_reason from {v_appt}
union all
select id, start_date + 10, end_date, 'Non-cabinet', false, false, cast(null as varchar(20))
from {v_appt} where id % 4 = 0 and end_date > start_date + 10"""

VIEWS["v_repr"] = """
select o_orderkey as id, o_custkey as person_id,
 case o_orderkey % 3 when 0 then 'Commons' when 1 then 'Lords' else 'Other' end as house,
 cast(o_orderdate as date) as start_date,
 cast(lead(o_orderdate) over (partition by o_custkey order by o_orderdate, o_orderkey) as date) as end_date
from {orders} where o_orderkey % 10 <> 0"""

VIEWS["v_repr_spell"] = """
select id as representation_id, start_date, end_date from {v_repr}
union all
select id, start_date - 5, end_date from {v_repr} where id % 6 = 0"""

VIEWS["v_known"] = """
select date '2021-10-09' as run_date, c_custkey as id, c_name as name, lower(replace(c_name, '#', '-')) as slug
from {customer} where c_custkey % 3 = 0
union all
select date '2022-07-02', c_custkey, c_name, lower(replace(c_name, '#', '-')) from {customer} where c_custkey % 5 = 0"""

# the name a person had, and the seats taken, on the day an appointment began
VIEWS["v_name_that_day"] = """
select v.id as appointment_id, n.id as person_id, n.name as person_name
from (select id, person_id, start_date as day from {v_appt}) v, {v_person} n
where n.id = v.person_id and not coalesce(v.day < n.start_date, false) and not coalesce(v.day >= n.end_date, false)"""

VIEWS["v_seat_that_day"] = """
select v.id as appointment_id, s.id as representation_id, s.house,
 case s.house when 'Commons' then 'MP' when 'Lords' then 'Peer' end as mp_peer
from {v_repr} s, (select id, person_id, start_date as day from {v_appt}) v
where s.person_id = v.person_id and v.day between s.start_date and coalesce(s.end_date - 1, date '9999-12-30')"""

VIEWS["v_office"] = """
select x.id as post_id, x.name as post_name, x.rank_equivalence as post_rank, y.id as organisation_id, y.short_name as organisation_short_name
from {v_org} y, {v_post} x where x.organisation_id = y.id"""

VIEWS["v_appt_full"] = """
select d.appointment_id, d.person_id, d.person_name, seat.mp_peer, f.post_name, f.organisation_short_name, f.post_rank,
 s.cabinet_status, s.is_on_leave, s.is_acting, s.leave_reason, s.start_date, s.end_date
from {v_name_that_day} d
 join (select * from {v_spell} where year(start_date) >= 1999) s using (appointment_id)
 join (select id as appointment_id, post_id from {v_appt}) held using (appointment_id)
 join {v_office} f using (post_id)
 left join {v_seat_that_day} seat using (appointment_id)"""

VIEWS["v_ext_appt"] = """
select concat('g', a.id) as appointment_id, a.person_id, concat(p.c_name, ' MP') as person_name,
 case a.id % 4 when 0 then t.name when 1 then replace(t.name, 'Minister for ', 'Minister for the ')
  when 2 then substring(t.name, 1, length(t.name) - 1) else concat(t.name, ' and Trade') end as post_name,
 case when a.id % 8 <> 0 then t.rank_equivalence end as post_rank, a.id % 13 = 0 as is_on_leave, a.id % 17 = 0 as is_acting,
 cast(null as varchar(20)) as leave_reason,
 case when a.id % 5 = 0 then 'XX' else o.short_name end as organisation_short_name,
 a.start_date + cast(a.id % 25 as int) as start_date, a.end_date + cast(a.id % 41 as int) as end_date
from {v_appt} a inner join {customer} p on a.person_id = p.c_custkey inner join {v_post} t on a.post_id = t.id
 inner join {v_org} o on t.organisation_id = o.id"""

VIEWS["v_workflow"] = """
select i.appointment_id as appointment_id_core, i.person_id, i.person_name as person_name_core, i.mp_peer,
 i.post_name as post_name_core, i.post_rank as post_rank_core, i.organisation_short_name as organisation_short_name_core,
 i.start_date as start_date_core, i.end_date as end_date_core, g.appointment_id as appointment_id_ext,
 g.post_name as post_name_ext, g.post_rank as post_rank_ext, g.organisation_short_name as organisation_short_name_ext,
 g.start_date as start_date_ext, g.end_date as end_date_ext, i.appointment_id % 5 <> 0 as reviewed,
 (i.appointment_id + cast(substring(g.appointment_id, 2, 20) as bigint)) % 3 = 0 as match_accepted,
 i.appointment_id % 2 = 0 as replace_post_name, case when i.appointment_id % 19 = 0 then 'check' end as notes
from {v_appt_full} i inner join {v_ext_appt} g on i.person_id = g.person_id"""

VIEWS["v_post_rel"] = """
select id + 1000000 as id, id as post_id, replace(name, 'Minister for ', '') as group_name,
 case when rank_equivalence in ('MoS', 'PUSS') then 'MoS/PUSS' else rank_equivalence end as group_seniority
from {v_post} where id % 2 = 0"""

VIEWS["v_decisions"] = """
select appointment_id_core, appointment_id_ext, appointment_id_core % 3 = 0 as match_accepted,
 case when appointment_id_core % 4 <> 0 then appointment_id_core % 2 = 0 end as replace_post_name
from (select distinct appointment_id_core, appointment_id_ext from {v_workflow} where appointment_id_core % 7 = 0) d"""

VIEWS["v_reviewed"] = """
select c_custkey as df_left_id, c_custkey + 500000 as df_right_id, c_name as name_df_left,
 concat(c_name, ' MP') as name_df_right, lower(replace(c_name, '#', '-')) as slug,
 case when c_custkey % 4 = 3 then null when c_custkey % 2 = 0 then 'Y' else 'N' end as accept,
 case when c_custkey % 5 = 0 then concat(c_name, ' X') end as replacement_name,
 case when c_custkey % 5 = 0 then concat('x-', c_custkey) end as replacement_slug from {customer}"""

VIEWS["v_source_base"] = """
select a.person_id, concat('p', a.person_id) as content_id, c.c_name as full_name, concat('g', a.id) as role_appointment_id,
 case when a.id % 11 = 0 then 'board_member_role' else 'ministerial_role' end as document_type,
 case when a.id % 29 = 0 then null when a.id % 23 = 0 then 'First Lord of the Treasury' else t.name end as title,
 case a.id % 43 when 1 then 'Deputy Prime Minister''s Office' when 2 then 'Government Equalities Office'
  when 3 then 'Prime Minister''s Office, 10 Downing Street' when 4 then 'UK Export Finance' when 5 then 'UK Trade & Investment'
  when 6 then 'Government Equalities Office (old)' else o.n_name end as org_title, case a.id % 4 when 0 then null when 1 then 'D12' when 2 then 'd34' else 'EA9' end as analytics_identifier,
 a.start_date as started_on, a.end_date as ended_on
from {v_appt} a inner join {customer} c on a.person_id = c.c_custkey inner join {v_post} t on a.post_id = t.id
 left join {nation} o on t.organisation_id = o.n_nationkey and a.id % 31 <> 0"""

VIEWS["v_source_rows"] = """
select *, 'en' as locale from {v_source_base}
union all select *, 'cy' from {v_source_base}
union all select *, 'en' from {v_source_base}"""

VIEWS["v_titles"] = """
select p_partkey as id, p_partkey % 23 as k, p_name as topic,
 case p_partkey % 23
  when 0 then concat('Minister for ', p_name)
  when 1 then concat('Minister of State (', p_name, ')')
  when 2 then concat('Minister of State (Minister for ', p_name, ')')
  when 3 then concat('Minister of State for ', p_name, ' at the A Office')
  when 4 then concat('Minister of State for Cabinet Office (', p_name, ')')
  when 5 then concat('Parliamentary Under Secretary of State and Minister for ', p_name)
  when 6 then concat('Parliamentary Under Secretary of State for ', p_name)
  when 7 then concat('Parliamentary Under Secretary of State, Minister for ', p_name)
  when 8 then concat('Parliamentary Secretary (Minister for ', p_name, ')')
  when 9 then concat('Parliamentary Secretary for ', p_name)
  when 10 then concat('Minister on Leave (Minister of State for ', p_name, ')')
  when 11 then concat('Interim Minister of State for ', p_name)
  when 12 then concat('Parliamentary Under Secretary of State for ', p_name, ' (maternity cover)')
  when 13 then concat('Minister of State (', p_name, ' & U – joint with FCDO and Defra)')
  when 14 then concat('Minister for ', p_name, ', and Minister for Equalities')
  when 15 then 'Parliamentary Under Secretary of State (Minister for the Lords)'
  when 16 then concat('Minister for ', p_name, ', and Lords Minister')
  when 18 then concat('Minister of State (Lords Minister for ', p_name, ')')
  when 19 then concat('Minister for ', p_name, ' (Lords Minister)')
  when 20 then concat('Minister for ', p_name, ' and DCMS Lords Minister')
  when 21 then concat('Minister for ', p_name, ' and Lords Minister')
  when 22 then concat('Minister for ', p_name, ' (Lords Minister) and Lords Minister')
  else concat('Minister on Leave ', p_name) end as post_name,
 case p_partkey % 23
  when 7 then concat('Minister for Minister for ', p_name)
  when 13 then concat('Minister for ', p_name, ' and U')
  when 15 then 'Parliamentary Under-Secretary of State'
  when 17 then concat('Minister on Leave ', p_name)
  when 22 then concat('Minister for ', p_name, ' and Lords Minister')
  else concat('Minister for ', p_name) end as exp_name,
 case when p_partkey % 23 in (1, 2, 3, 4, 10, 11, 13, 18) then 'MoS'
  when p_partkey % 23 in (5, 6, 7, 8, 9, 12, 15) then 'PUSS' end as exp_rank,
 p_partkey % 23 in (10, 17) as exp_is_on_leave,
 p_partkey % 23 in (11, 12) as exp_is_acting,
 case when p_partkey % 23 in (10, 17) then 'Maternity leave' end as exp_leave_reason
from {part}"""

# titles, people and organisations that the rules name, in all their combinations: 52 x 14 x 16 of them, in turn
_TITLES, _PEOPLE, _OFFICES = all_titles(), all_people(), all_organisations()
_TURN = "((l.l_orderkey * 8 + l.l_linenumber) - (l.l_orderkey * 8 + l.l_linenumber) % {0}) / {0} % {1}"
VIEWS["v_rule_rows"] = f"""
select l.l_orderkey * 8 + l.l_linenumber as id, t.title as post_name, w.person as person_name, o.name as organisation_name, o.short as organisation_short_name
from {{lineitem}} l
 join {rows_of([(t,) for t in _TITLES], "title")} t on t.n = (l.l_orderkey * 8 + l.l_linenumber) % {len(_TITLES)}
 join {rows_of([(x,) for x in _PEOPLE], "person")} w on w.n = {_TURN.format(len(_TITLES), len(_PEOPLE))}
 join {rows_of(_OFFICES, "name", "short")} o on o.n = {_TURN.format(len(_TITLES) * len(_PEOPLE), len(_OFFICES))}"""

VIEWS["v_titled_names"] = """
select c_custkey as id, case when c_custkey % 2 = 0 then concat('The Rt Hon ', c_name, ' MP') else concat('Baroness ', c_name) end as name,
 case when c_custkey % 2 = 0 then c_name else concat('Baroness ', c_name) end as exp_name
from {customer}"""

# people to look for, and the listing to find them in
VIEWS["v_seekers"] = """
select c.c_custkey as id, concat(p.p_name, ' ', c.c_custkey) as name
from {customer} c inner join {part} p on p.p_partkey = c.c_custkey"""

# the same under several names a person: three names of neighbouring customers belong to one id
VIEWS["v_many_named"] = "select id - id % 3 as id, name from {v_seekers}"

# some names are held by two listed people
VIEWS["v_listing"] = """
select s.s_suppkey as id, concat(p.p_name, ' ', s.s_suppkey) as name, concat('s-', s.s_suppkey) as slug
from {supplier} s inner join {part} p on p.p_partkey = s.s_suppkey * 7
union all
select s.s_suppkey + 500000, concat(p.p_name, ' ', s.s_suppkey), concat('s-', s.s_suppkey, '-2')
from {supplier} s inner join {part} p on p.p_partkey = s.s_suppkey * 7 where s.s_suppkey % 3 = 0"""

# dates as they come in payloads: with a time and an offset, or not dates at all
VIEWS["v_dated_rows"] = """
select r.*, case cast(right(role_appointment_id, 1) as int)
  when 3 then concat(cast(started_on as varchar(10)), 'T00:00:00+01:00') when 7 then concat(cast(started_on as varchar(10)), ' 23:30:00-05:00')
  when 9 then 'not known' else cast(started_on as varchar(10)) end as started_text,
 case cast(right(role_appointment_id, 1) as int)
  when 4 then concat(cast(ended_on as varchar(10)), 'T23:59:59.5-08:00') when 8 then ' ' else cast(ended_on as varchar(10)) end as ended_text
from {v_source_rows} r"""

# pages whose list is nested, has an unknown entity or a comment, and pagination
VIEWS["v_crawled"] = """
select page_id, url, case page_id % 4
 when 0 then html
 when 1 then replace(html, '</a></li>', '</a><ul><li><a href="/in/side">caf&eacute; &amp; bar</a></li></ul></li>')
 when 2 then replace(html, '<ul>', '<ul><!-- <li><a href="/no">no</a></li> -->')
 else html end as html, concat('/crawl?page=', page_id + 1) as next_href from {pages}"""

# titles with one topic or two, and with reserved phrases in brackets, next to the topic they are about
VIEWS["v_topics"] = """
select p_partkey as id, case p_partkey % 7
  when 0 then concat('Minister for ', p_name) when 1 then concat('Minister of State for ', p_name, ' (Yorkshire and the Humber)')
  when 2 then concat('Minister for ', p_name, ' and Minister for Trade')
  when 3 then concat('Minister for ', p_name, ' (Safe and Legal Migration, Violence Against Women and Girls)')
  when 4 then concat('Secretary of State for ', p_name, ', Minister for Women (joint)')
  when 5 then concat('Minister for Safe and Legal Migration and Minister of State for ', p_name) else concat('  Minister of ', p_name, ' (', p_brand, ') ') end as post_name,
 case p_partkey % 7 when 1 then 'Yorkshire and the Humber' when 2 then concat(p_name, ' and Trade')
  when 3 then 'Violence Against Women and Girls and Safe and Legal Migration' when 4 then concat(p_name, ', Women')
  when 5 then concat('Safe and Legal Migration and ', p_name) else p_name end as exp_topic
from {part}"""

# titles of 65 to 500 characters and edited copies of them
VIEWS["v_long_titles"] = """
select id, a, case id % 5 when 0 then replace(a, ' ', '  ') when 1 then substring(a, 3, 400) when 2 then concat(substring(a, 40, 500), substring(a, 1, 39))
  when 3 then concat(a, ' of ', a) else replace(replace(a, '1', '#'), 'e', 'é') end as b
from (select s_suppkey as id, substring(repeat(concat(s_name, ' of ', n_name, ', ', s_suppkey * 7919, ' '), 14), 1, cast(65 + s_suppkey * 37 % 186 as int)) as a
 from {supplier} inner join {nation} on n_nationkey = s_nationkey) t"""

_NAME = re.compile(r"\{(\w+)\}")


class Frames:
    """Driver tables and views of one data folder as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._made: dict[str, DataFrame] = {}

    def landed(self, name: str) -> DataFrame:
        """A view written out first, as a run's table is before its changes are drawn up."""
        landed = f"{name}#landed"
        if landed not in self._made:
            self._made[landed] = land(getattr(self, name), name)
        return self._made[landed]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._made:
            if name in VIEWS:
                sql = VIEWS[name]
                self._made[name] = self.spark.sql(sql, **{n: getattr(self, n) for n in set(_NAME.findall(sql))})
            else:
                self._made[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._made[name]


def with_views(sql: str, recursive: bool = False) -> str:
    """The query with every view it names in braces put in front as a WITH clause."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in _NAME.findall(text):
            if name in VIEWS and name not in needed:
                visit(VIEWS[name])
                needed.append(name)

    visit(sql)
    plain = lambda text: _NAME.sub(r"\1", text)
    clauses = [f"{name} as ({plain(VIEWS[name])})" for name in needed]
    body = plain(sql).strip()
    if body.lower().startswith("with "):
        clauses.append(body[5:])
        return f"with {'recursive ' if recursive else ''}" + ",\n".join(clauses)
    if not clauses:
        return body
    return f"with {'recursive ' if recursive else ''}" + ",\n".join(clauses) + "\n" + body
