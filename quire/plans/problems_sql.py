"""SQL twins of the general data problems."""

from __future__ import annotations

_SECTION = r"""
  case when regexp_extract({c}, '([0-9]+)', 1) <> '' then regexp_replace(regexp_extract({c}, '([0-9]+)', 1), '^0+([0-9])', '\1')
       when trim(regexp_replace(lower({c}), '[\s\x{{00A0}}]+', ' ', 'g')) <> '' then trim(regexp_replace(lower({c}), '[\s\x{{00A0}}]+', ' ', 'g')) end"""

_DEAD = f"""
with refs as (
  select distinct 'enriched_portions' as src_table, portion_key as src_key, i - 1 as ref_pos, run_id, loaded_at, c.target as t
  from (select portion_key, run_id, loaded_at, unnest(choices) as c, generate_subscripts(choices, 1) as i from enriched_portions)
  union all
  select distinct 'gamebook_sections', section_key, i - 1, run_id, loaded_at, e.targetSection
  from (select section_key, run_id, loaded_at, unnest(sequence) as e, generate_subscripts(sequence, 1) as i from gamebook_sections)
  where e.kind = 'choice'),
named as (select src_table, src_key, ref_pos, run_id, loaded_at, {_SECTION.format(c="translate(t, '０１２３４５６７８９', '0123456789')")} as section from refs),
there as (select run_id, {_SECTION.format(c="translate(section_id, '０１２３４５６７８９', '0123456789')")} as section, loaded_at, deleted_at from gamebook_sections),
dead as (
  select * from named r where section is not null and not exists (
    select 1 from there g where g.run_id = r.run_id and g.section = r.section
      and g.loaded_at <= r.loaded_at and (g.deleted_at is null or g.deleted_at > r.loaded_at)))
"""

_SPANS = """
with el as (select distinct run_id, id, seq from elements_core_content_types_rubric_v1),
last as (select run_id, max(seq) as last_seq from el group by run_id),
b as (
  select s.run_id, e1.seq as s, s.end_element_id, e2.seq as e
  from (select distinct boundary_key, run_id, start_element_id, end_element_id from section_boundaries_scan) s
  join el e1 on e1.run_id = s.run_id and e1.id = s.start_element_id
  left join el e2 on e2.run_id = s.run_id and e2.id = s.end_element_id
  where s.end_element_id is null or e2.seq is not null),
nx as (select run_id, s, lead(s) over (partition by run_id order by s) as n from (select distinct run_id, s from b)),
rows_ as (
  select 'boundaries' as src_table, b.run_id, b.s, case when end_element_id is null then coalesce(nx.n - 1, last_seq) else b.e end as e
  from b join nx on nx.run_id = b.run_id and nx.s = b.s join last on last.run_id = b.run_id
  union all
  select 'macro', run_id, m.start_seq, m.end_seq from (select run_id, unnest(macro_sections) as m from sections_structured_stub)),
marked as (
  select *, case when s <= max(e) over (partition by src_table, run_id order by s, e rows between unbounded preceding and 1 preceding) + 1 then 0 else 1 end as fresh
  from rows_ where s <= e),
isles as (select *, sum(fresh) over (partition by src_table, run_id order by s, e rows unbounded preceding) as isle from marked),
spans as (select src_table, run_id, min(s) as s, max(e) as e from isles group by src_table, run_id, isle)
select src_table, run_id, 'span' as kind, s as start_seq, e as end_seq from spans
union all
select src_table, run_id, 'gap', e + 1, n - 1 from (
  select *, lead(s) over (partition by src_table, run_id order by s) as n from spans) where n is not null
"""


def _things(j: str) -> str:
    """List of (pos, v) of a JSON value: array, object keyed by number, one thing alone."""
    return f"""case
      when json_type({j}) = 'ARRAY' then list_transform(from_json({j}, '["JSON"]'), lambda x, i: {{'pos': i - 1, 'v': x}})
      when json_type({j}) = 'OBJECT' and len(json_keys({j})) > 0 and len(list_filter(json_keys({j}), lambda k: not regexp_full_match(k, '[0-9]{{1,9}}'))) = 0
        then list_transform(json_keys({j}), lambda k: {{'pos': cast(k as bigint), 'v': json_extract({j}, '$.' || k)}})
      when json_type({j}) = 'OBJECT' or (json_type({j}) = 'VARCHAR' and trim(json_extract_string({j}, '$')) <> '') then [{{'pos': 0, 'v': {j}}}]
      else [] end"""


def _there(j: str) -> str:
    return f"({j} is not null and json_type({j}) <> 'NULL' and not (json_type({j}) = 'OBJECT' and len(list_filter(json_keys({j}), lambda k: json_type(json_extract({j}, '$.' || k)) <> 'NULL')) = 0))"


def _inner(j: str) -> str:
    """JSON inside a JSON text counts as that JSON."""
    return f"case when json_type({j}) = 'VARCHAR' and json_valid(json_extract_string({j}, '$')) then cast(json_extract_string({j}, '$') as json) else {j} end"


_P4 = f"""
with typed as (
  select portion_key, i - 1 as p1, f.enemies as es from (
    select portion_key, unnest(combat) as f, generate_subscripts(combat, 1) as i from enriched_portions)),
enemy as (
  select 'enemy' as child, portion_key as parent_key, p1 as pos1, i - 1 as pos2 from (
    select portion_key, p1, unnest(es) as e, generate_subscripts(es, 1) as i from typed)
  where coalesce(e.enemy, cast(e.skill as varchar), cast(e.stamina as varchar), cast(e.armour as varchar), cast(e.firepower as varchar), e.speed) is not null),
rec as (select raw_key, {_inner("j")} as j from (select raw_key, cast(record as json) as j from raw_portions where json_valid(record))),
cmb as (
  select raw_key, {_inner("c")} as c from (
    select raw_key, coalesce(json_extract(j, '$.combat'), json_extract(j, '$.data.portion.combat')) as c from rec)),
fights as (select raw_key, f.pos as p1, f.v as f from (select raw_key, unnest({_things("c")}) as f from cmb)),
inside as (
  select raw_key, p1, {_inner("e")} as e from (
    select raw_key, p1, case when json_extract(f, '$.enemies') is not null and json_type(json_extract(f, '$.enemies')) <> 'NULL' then json_extract(f, '$.enemies')
                             when json_extract(f, '$.enemy') is not null then json_array(f) end as e from fights)),
raw_enemy as (
  select 'raw_enemy', raw_key, p1, x.pos from (select raw_key, p1, unnest({_things("e")}) as x from inside) where {_there("x.v")}),
chs as (
  select report_key, {_inner("c")} as c from (
    select report_key, json_extract(cast(summary as json), '$.flagged_genealogy_chapters') as c from pipeline_issues where json_valid(summary))),
ch as (select report_key, x.pos as p1, x.v as v from (select report_key, unnest({_things("c")}) as x from chs) where {_there("x.v")}),
pg as (select report_key, p1, unnest({_things("d")}) as x from (select report_key, p1, json_extract(v, '$.source_page_details') as d from ch))
select child, parent_key, cast(pos1 as bigint) as pos1, cast(pos2 as bigint) as pos2 from (
  select * from enemy union select * from raw_enemy
  union select 'chapter', report_key, p1, -1 from ch
  union select 'chapter_page', report_key, p1, x.pos from pg where {_there("x.v")})
"""

SQL: dict[str, str] = {
    "p4_found": _P4,
    "p4_enemies": """
      select distinct portion_key, p1 as fight_pos, i - 1 as enemy_pos, e.enemy as enemy, e.skill as skill, e.stamina as stamina,
             e.armour as armour, e.firepower as firepower, e.speed as speed
      from (select portion_key, p1, unnest(es) as e, generate_subscripts(es, 1) as i from (
        select portion_key, i - 1 as p1, f.enemies as es from (
          select portion_key, unnest(combat) as f, generate_subscripts(combat, 1) as i from enriched_portions)))
      where coalesce(e.enemy, cast(e.skill as varchar), cast(e.stamina as varchar), cast(e.armour as varchar), cast(e.firepower as varchar), e.speed) is not null""",
    "p4_choices": """
      select distinct portion_key, i - 1 as choice_pos, c.target as target, c.text as choice_text
      from (select portion_key, unnest(choices) as c, generate_subscripts(choices, 1) as i from enriched_portions)
      where coalesce(c.target, c.text) is not null""",
    "p4_chapters": f"""
      with chs as (
        select report_key, {_inner("c")} as c from (
          select report_key, json_extract(cast(summary as json), '$.flagged_genealogy_chapters') as c from pipeline_issues where json_valid(summary)))
      select distinct report_key, x.pos as chapter_pos,
             case when json_type(x.v) = 'VARCHAR' then json_extract_string(x.v, '$') else json_extract_string(x.v, '$.chapter_basename') end as chapter_basename,
             cast(case when json_type(x.v) = 'OBJECT' then json_extract_string(x.v, '$.drift_score') end as double) as drift_score
      from (select report_key, unnest({_things("c")}) as x from chs) where {_there("x.v")}""",
    "p5_found": _DEAD + "select src_table, src_key, ref_pos from dead",
    "p5_state": _DEAD
    + """select run_id, section, count(*) as refs from named r where section is not null and not exists (
      select 1 from there g where g.run_id = r.run_id and g.section = r.section and g.deleted_at is null) group by 1, 2""",
    "p5_report": _DEAD
    + """select src_table, strftime(loaded_at at time zone 'UTC', '%Y-%m') as month, count(*) as dead_references, count(distinct (run_id, section)) as dead_targets
         from dead group by all""",
    "p6_found": _SPANS,
}
