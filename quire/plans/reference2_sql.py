"""SQL twins of the second set of document queries."""

from __future__ import annotations

from quire.plans.reference_sql import ANCHOR, BROKEN, EDGES, EL, LINES, NODES, ORPHANS, P, B, STRIP, TURN, count, jaccard, refs, section  # noqa: F401

FLAT = "regexp_replace(coalesce({c}, ''), '[ \\t\\r\\n]+', ' ', 'g')"
WORD_NUMBER = "case when regexp_full_match(lower({c}), '[0-9]+') then cast({c} as int) else nullif(list_position(['one', 'two', 'three', 'four', 'five', 'six', 'seven', 'eight', 'nine', 'ten', 'eleven', 'twelve'], lower({c})), 0) end"
STATUS = "list_extract(['queued', 'running', 'done', 'failed', 'skipped', 'warning'], cast(event_id % 6 + 1 as int))"


def places(source: str, keys: str, pattern: str, groups: list[str]) -> str:
    """Rows of (keys, place, groups) for every match of a pattern in ``t`` of a source."""
    per = ", ".join(f"unnest(regexp_extract_all(t, '{pattern}', {i + 1})) as {g}" for i, g in enumerate(groups))
    return f"select {keys}, unnest(range(len(regexp_extract_all(t, '{pattern}', 1)))) as place, {per} from {source}"


_BLOCK = "([A-Z][A-Z'' -]{2,30}?)[ ]+SKILL:?[ ]*([0-9]{1,2})[ ]+STAMINA:?[ ]*([0-9]{1,2})"
_CHANGE = "(?i)(lose|gain|deduct|restores?|add)[ ]+([a-z]+|[0-9]+)[ ]+points?[ ]+of[ ]+(stamina|skill|luck)"
_ITEM = "(?i)if[ ]+you[ ]+have[ ]+an?[ ]+([a-z-]+),"
_START = "(?i)begin[ ]+the[ ]+adventure[ ]+with[ ]+an?[ ]+([a-z-]+),[ ]+an?[ ]+([a-z-]+)"
_FLATS = f"flats as (select element_key, run_id, {FLAT.format(c='text')} as t from el)"
_PAGE = f"pages as (select run_id, page, max(length({STRIP.format(c='html')})) as chars, max((page_number is not null)::int) as numbered, max((html like '%<h2>%')::int) as headed from pages_html group by 1, 2)"

SQL: dict[str, str] = {
    "combat_stat_blocks": f"with {EL}, {_FLATS}, m as ({places('flats', 'element_key', _BLOCK, ['enemy', 'skill', 'stamina'])}) select element_key, place, trim(enemy, ' ') as enemy, cast(skill as int) as skill, cast(stamina as int) as stamina from m",
    "stat_changes": f"""with {EL}, {_FLATS}, m as ({places('flats', 'element_key', _CHANGE, ['verb', 'amount', 'stat'])}), n as (select element_key, place, case when lower(verb) in ('lose', 'deduct') then -1 else 1 end * ({WORD_NUMBER.format(c='amount')}) as amount, lower(stat) as stat from m)
      select * from n where amount is not null""",
    "item_checks": f"with {EL}, {_FLATS}, m as ({places('flats', 'element_key', _ITEM, ['item'])}) select lower(item) as item, count(*) as checks, count(distinct element_key) as elements from m group by 1",
    "starting_items": f"with {EL}, {_FLATS}, m as ({places('flats', 'run_id', _START, ['first', 'second'])}) select distinct run_id, first, second from m",
    "event_targets": f"""with g as (select distinct section_key, sequence from gamebook_sections), e as (select section_key, unnest(sequence) as e, generate_subscripts(sequence, 1) - 1 as pos from g),
        t as (select section_key, pos, e.kind as kind, unnest([{{'p': 'target', 't': e.targetSection}}, {{'p': 'outcomes.win', 't': e.outcomes.win.targetSection}}, {{'p': 'outcomes.lose', 't': e.outcomes.lose.targetSection}}]) as x from e)
      select section_key, pos, kind, x.p as path, {section('x.t')} as section from t where x.t is not null and trim(x.t, ' ') <> ''""",
    "event_kinds": "with e as (select unnest(sequence) as e from (select distinct section_key, sequence from gamebook_sections)) select e.kind as kind, count(*) as events, count(e.targetSection) as with_target, count(e.outcomes) as with_outcomes from e group by 1",
    "fight_styles": """with p as (select distinct portion_key, lower(coalesce(raw_text, '')) as t from enriched_portions where len(combat) > 0)
      select case when regexp_matches(t, 'vehicle|chariot|carriage') then 'vehicle' when regexp_matches(t, 'robot|golem|automaton') then 'machine' when regexp_matches(t, 'shoot|arrow|crossbow|blaster') then 'shooting' when regexp_matches(t, 'fist|wrestle|bare hands') then 'hand' else 'standard' end as style,
        count(*) as portions from p group by 1""",
    "merged_turn_to": """with p as (select distinct portion_key, turn_to_links, choices from enriched_portions), u as (select portion_key, unnest(list_concat(coalesce(turn_to_links, []), coalesce(list_transform(choices, lambda c: c.target), []))) as t,
          generate_subscripts(list_concat(coalesce(turn_to_links, []), coalesce(list_transform(choices, lambda c: c.target), [])), 1) as i from p),
        f as (select portion_key, trim(t, ' ') as t, min(i) as i from u where trim(t, ' ') <> '' group by 1, 2)
      select portion_key, string_agg(t, '|' order by i) as targets from f group by 1""",
    "enemy_strength": """with f as (select unnest(combat) as f from (select distinct portion_key, combat from enriched_portions)), e as (select unnest(f.enemies) as e from f)
      select upper(trim(e.enemy, ' ')) as enemy, count(*) as fights, round(avg(e.skill), 4) as skill, round(avg(e.stamina), 4) as stamina from e where e.enemy is not null group by 1""",
    "single_fight_outcomes": """with f as (select unnest(combat) as f from (select distinct portion_key, combat from enriched_portions))
      select coalesce(f.mode, '') as mode, coalesce(f.style, '') as style, count(*) as fights, count(f.outcomes) as with_outcomes from f where f is not null group by 1, 2""",
    "element_positions": """with e as (select distinct element_key, layout.y as y, coalesce(layout.h_align, '') as h_align from elements_core_content_types_rubric_v1)
      select case when y is null then 'unknown' when y <= 0.10 then 'top' when y >= 0.90 then 'bottom' else 'middle' end as position, h_align, count(*) as elements from e group by 1, 2""",
    "repeated_edge_texts": f"""with {EL}, l as (select distinct run_id, page, lower(trim(regexp_replace(text, '[ \\t\\r\\n\\f]+', ' ', 'g'), ' ')) as line from el where length(text) between 5 and 60)
      select run_id, line, count(*) as pages from l group by 1, 2 having count(*) >= 3""",
    "numeric_sequences": f"""with {EL}, e as (select run_id, page, max(cast(trim(text, ' ') as int)) as n from el where regexp_full_match(trim(text, ' '), '[0-9]{{1,3}}') group by 1, 2),
        c as (select *, coalesce((n <> lag(n) over (partition by run_id order by page) + 1)::int, 1) as fresh from e), i as (select *, sum(fresh) over (partition by run_id order by page) as k from c)
      select run_id, min(n) as first, max(n) as last, count(*) as length from i group by run_id, k having count(*) >= 3""",
    "page_flags": f"with {_PAGE} select run_id, count(*) as pages, sum((chars = 0)::int) as blank, round(avg(numbered), 4) as numbered, round(avg(case when chars > 0 then headed end), 4) as headed from pages group by 1",
    "blank_between_pages": f"with {_PAGE}, n as (select *, lag(chars) over w as b, lead(chars) over w as a from pages window w as (partition by run_id order by page)) select run_id, page from n where chars = 0 and b > 0 and a > 0",
    "spread_sides": "with p as (select distinct page_key, run_id, page, spread_side from pages_html where spread_side is not null) select run_id, count(*) as pages, sum(((spread_side = 'R' and page % 2 = 1) or (spread_side = 'L' and page % 2 = 0))::int) as as_expected from p group by 1",
    "chapters_by_heading": """with x as (select run_id, page, unnest(regexp_extract_all(html, '<h1>([^<]+)</h1>', 1)) as title, generate_subscripts(regexp_extract_all(html, '<h1>([^<]+)</h1>', 1), 1) - 1 as pos from pages_html),
        h as (select distinct run_id, page, pos, trim(regexp_replace(title, '[ \\t\\r\\n\\f]+', ' ', 'g'), ' ') as title from x), k as (select *, lag(title) over (partition by run_id order by page, pos, title) as prev from h),
        m as (select *, lead(page) over (partition by run_id order by page, pos, title) as nx from k where prev is null or prev <> title), z as (select run_id, max(page) as last_page from pages_html group by 1)
      select m.run_id, title, page as first_page, greatest(page, coalesce(nx - 1, last_page)) as last_page from m join z on z.run_id = m.run_id""",
    "page_text_lengths": f"with {_PAGE} select run_id, min(chars) as least, quantile_cont(chars, 0.5) as median, max(chars) as most from pages group by 1",
    "label_majority": """with t as (select src_table, rec_key, label, count(*) as n from text_labels group by 1, 2, 3) select src_table, rec_key, arg_min(label, (-n, label)) as label, sum(n) as votes from t group by 1, 2""",
    "section_lineage": "{LINEAGE} select * from l",
    "lineage_gaps": "{LINEAGE} select run_id, case when in_boundaries = 1 and in_portions = 0 then 'portions' when in_portions = 1 and in_gamebook = 0 then 'gamebook' when in_boundaries = 0 then 'boundaries' else 'none' end as lost_in, count(*) as sections from l group by 1, 2",
    "choice_completeness": f"""with g as (select distinct section_key, html, sequence from gamebook_sections where deleted_at is null),
        r as (select section_key, case when len({refs('html', ANCHOR)}) > 0 then {refs('html', ANCHOR)} else {refs(STRIP.format(c='html'), TURN)} end as refs,
          list_distinct(list_filter(list_transform(list_filter(coalesce(sequence, []), lambda e: e.kind = 'choice'), lambda e: try_cast({section('e.targetSection')} as int)), lambda x: x is not null)) as held from g),
        c as (select section_key, len(list_filter(refs, lambda x: not list_contains(held, x))) as missing, len(list_filter(held, lambda x: not list_contains(refs, x))) as extra from r)
      select *, missing + extra = 0 as valid from c""",
    "relaxed_index": f"with {EDGES} select run_id, dst, string_agg(src, ',' order by src) as sources from edges group by 1, 2",
    "unreachable_groups": f"""with {NODES}, {EDGES}, {ORPHANS.format(x="'1', 'background'")} select distinct run_id, dst from edges e where exists (select 1 from orphans o where o.run_id = e.run_id and o.section = e.src)
      and not exists (select 1 from edges f where f.run_id = e.run_id and f.dst = e.dst and not exists (select 1 from orphans o where o.run_id = f.run_id and o.section = f.src))""",
    "chapter_drift": f"""with s as (select distinct page_key, {count('html', '<th[ >]')} as r, {count('html', '<h1[ >]')} as x, {count('html', '<table')} as t, {count('html', '<h2[ >]')} as g from pages_html)
      select page_key, case when r >= 3 then 35 when r >= 1 then 25 else 0 end + case when x > 0 then 25 else 0 end + case when t >= 5 and t >= 1.25 then 20 else 0 end + case when t >= 3 and g = 0 then 20 else 0 end as drift from s where t > 0""",
    "event_state": f"""with e as (select cast(user_id as varchar) as run_id, event_type as stage, {STATUS} as status, ts, event_id from events)
      select run_id, stage, coalesce(arg_max(status, (ts, status)) filter (status <> 'warning'), 'running') as status, cast(arg_max(event_id, (ts, event_id)) as int) as current, count(*) as events from e group by 1, 2""",
    "usage_by_minute": "select strftime(date_trunc('hour', ts), '%Y-%m-%d %H') as hour, event_type as model, count(*) as calls, sum(user_id) as prompt_tokens, sum(length(props)) as completion_tokens from events group by 1, 2",
    "book_totals": """with p as (select book_id, count(distinct run_id) as runs, count(distinct page_key) as pages from pages_html group by 1), g as (select book_id, count(distinct section_key) as sections from gamebook_sections group by 1),
        j as (select book_kind, lang, coalesce(runs, 0) as runs, coalesce(pages, 0) as pages, coalesce(sections, 0) as sections from books b left join p on p.book_id = b.book_id left join g on g.book_id = b.book_id)
      select coalesce(book_kind, 'all') as book_kind, coalesce(lang, 'all') as lang, count(*) as books, sum(runs) as runs, sum(pages) as pages, sum(sections) as sections from j group by cube (book_kind, lang)""",
    "revenue_by_nation": """with l as (select l_orderkey, sum(cast(l_extendedprice as decimal(12,2)) * (cast(1 as decimal(3,2)) - cast(l_discount as decimal(12,2)))) as revenue from lineitem group by 1)
      select n_name, year(o_orderdate) as year, count(*) as orders, cast(round(sum(revenue), 2) as double) as revenue from orders join l on l_orderkey = o_orderkey join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey group by 1, 2""",
    "interval_join_counts": f"with {P}, {B} select portion_key, count(*) as boundaries from p join b on b.run_id = p.run_id and b.start_page between p.page_start and p.page_end group by 1",
    "run_reuse": f"""with {NODES}, {EDGES}, {ORPHANS.format(x="'1', 'background'")}, {BROKEN}, {B}, n as (select distinct run_id from nodes),
        h as (select run_id, exists (select 1 from orphans o where o.run_id = n.run_id) as o, exists (select 1 from broken k where k.run_id = n.run_id) as k from n),
        s as (select run_id, case when not o and not k then 'healthy' when k then 'broken' else 'orphans' end as status from h), a as (select run_id, case when max(confidence) < 0.9 then 'bad' else 'good' end as assessment from b group by 1)
      select s.run_id, status, assessment, case when assessment = 'bad' or status = 'broken' then 'rebuild' when assessment is null then 'review' when status = 'healthy' then 'reuse' else 'patch' end as advice from s left join a on a.run_id = s.run_id""",
    "voted_lines": f"""with {EL}, o as (select run_id, page, text, row_number() over (partition by run_id, page order by seq, element_key) as i, row_number() over (partition by run_id, page order by -seq, element_key) as j from el where text is not null),
        a as (select run_id, page, string_split(text, chr(10)) as a from o where i = 1), b as (select run_id, page, string_split(text, chr(10)) as b from o where j = 1)
      select run_id, page, md5(array_to_string(list_transform(range(1, greatest(len(a), len(b)) + 1), lambda i: case when b[i] is null then a[i] when a[i] is null then b[i] when length(trim(b[i], ' ')) > length(trim(a[i], ' ')) then b[i] else a[i] end), chr(10))) as digest
      from a join b using (run_id, page)""",
    "previous_event": "select e.event_id, (select arg_max(f.event_id, (f.ts, f.event_id)) from events f where f.user_id = e.user_id and f.event_type <> e.event_type and (f.ts, f.event_id) < (e.ts, e.event_id)) as previous_id from events e",
}
_LINEAGE = f"""with b as (select distinct run_id, {section('section_id')} as section from section_boundaries_scan), p as (select distinct run_id, {section('section_id')} as section from enriched_portions), g as (select distinct run_id, {section('section_id')} as section from gamebook_sections),
  u as (select *, 1 as x, 0 as y, 0 as z from b union all select *, 0, 1, 0 from p union all select *, 0, 0, 1 from g),
  l as (select run_id, section, max(x) as in_boundaries, max(y) as in_portions, max(z) as in_gamebook from u where section is not null group by 1, 2)"""
for _k in ("section_lineage", "lineage_gaps"):
    SQL[_k] = SQL[_k].replace("{LINEAGE}", _LINEAGE)
