"""SQL twins of the fifth set of document queries."""

from __future__ import annotations

from quire.plans.reference2_sql import FLAT, WORD_NUMBER
from quire.plans.reference_sql import EL, section

_DICE = "(?i)roll[ ]+([0-9]+|[a-z]+)(?:d6|[ ]+dice)([+-][0-9]+)?"
_LAST = "list_extract(regexp_extract_all(html, '{p}', 1), len(regexp_extract_all(html, '{p}', 1)))"

SQL: dict[str, str] = {
    "section_kinds": """with p as (select distinct portion_key, section_id as s, lower(coalesce(raw_text, '')) as t from enriched_portions)
      select case when s = 'background' then 'background' when regexp_full_match(s, '[0-9]+') then 'section' when regexp_matches(t, '^(rules|how to|equipment|hints)') then 'rules' when regexp_matches(t, '(publish|copyright|isbn)') then 'front_matter' else 'text' end as kind, count(*) as portions from p group by 1""",
    "page_phases": """with p as (select run_id, page, max(html) as html from pages_html group by 1, 2), v as (select run_id, coalesce(min(page) filter (contains(lower(html), 'background')), min(page) filter (regexp_matches(html, '(?i)turn to [0-9<]'))) as s from p group by 1),
        f as (select p.run_id, page, case when s is null then 'unknown' when page >= s then 'game' else 'front' end as phase from p join v on v.run_id = p.run_id)
      select run_id, phase, count(*) as pages, min(page) as first_page from f group by 1, 2""",
    "dice_checks": f"""with f as (select doc_id, {FLAT.format(c='text')} as t from documents), m as (select doc_id, unnest(range(len(regexp_extract_all(t, '{_DICE}', 1)))) as place, unnest(regexp_extract_all(t, '{_DICE}', 1)) as n, unnest(regexp_extract_all(t, '{_DICE}', 2)) as plus from f),
        k as (select doc_id, place, {WORD_NUMBER.format(c='n')} as dice, coalesce(try_cast(nullif(plus, '') as int), 0) as plus from m) select * from k where dice is not null""",
    "portion_events": f"""with p as (select distinct portion_key, choices, stat_checks, inventory, combat from enriched_portions),
        e as (select portion_key, 0 as g, i, 'choice' as kind, {section('c.target')} as detail from (select portion_key, unnest(choices) as c, generate_subscripts(choices, 1) as i from p) where c.target is not null
          union all select portion_key, 1, i, 'stat_check', s.stat from (select portion_key, unnest(stat_checks) as s, generate_subscripts(stat_checks, 1) as i from p) where s is not null
          union all select portion_key, 2, i, 'gain', x from (select portion_key, unnest(inventory.items_gained) as x, generate_subscripts(inventory.items_gained, 1) as i from p) where x is not null
          union all select portion_key, 3, i, 'loss', x from (select portion_key, unnest(inventory.items_lost) as x, generate_subscripts(inventory.items_lost, 1) as i from p) where x is not null
          union all select portion_key, 4, i, 'combat', array_to_string(list_transform(f.enemies, lambda e: coalesce(e.enemy, '?')), ',') from (select portion_key, unnest(combat) as f, generate_subscripts(combat, 1) as i from p) where len(f.enemies) > 0)
      select portion_key, row_number() over (partition by portion_key order by g, i) - 1 as pos, kind, detail from e""",
    "longest_item_names": """with i as (select distinct run_id, lower(trim(item, ' ')) as item from (select run_id, unnest(inventory.items_gained) as item from enriched_portions union all select run_id, unnest(inventory.items_lost) from enriched_portions) where trim(item, ' ') <> ''),
        t as (select *, regexp_extract(item, '([^ ]+)$', 1) as tail from i), l as (select *, max(length(item)) over (partition by run_id, tail) as n from t)
      select run_id, item from l where contains(item, ' ') or n = length(item)""",
    "paragraphs_of_lines": f"""with {EL}, x as (select run_id, page, seq, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) - 1 as i from el), y as (select run_id, page, seq * 1000000 + i as o, line from x where trim(line, ' ') <> ''),
        p as (select *, lag(line) over (partition by run_id, page order by o) as prev from y),
        f as (select *, (prev is null or regexp_full_match(line, '[ ]*[0-9]{{1,3}}[ ]*') or regexp_full_match(prev, '[ ]*[0-9]{{1,3}}[ ]*') or (length(prev) < 30 and regexp_matches(prev, '[.!?"]$')))::int as f from p),
        g as (select *, sum(f) over (partition by run_id, page order by o) as paragraph from f)
      select run_id, page, paragraph, count(*) as lines, length(string_agg(line, ' ' order by o)) as chars from g group by 1, 2, 3""",
    "printed_numbers": f"""with p as (select distinct page_key, html from pages_html), n as (select page_key, cast(coalesce({_LAST.format(p='class="page-number">[^0-9<]*([0-9]+)')}, {_LAST.format(p='<footer>[^0-9<]*([0-9]+)')},
        nullif(regexp_extract(html, '<p[^>]*>[^0-9<]{{0,4}}([0-9]+)[^0-9<]{{0,4}}</p>[ \\n]*$', 1), '')) as int) as printed from p) select * from n where printed is not null""",
}
