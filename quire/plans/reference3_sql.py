"""SQL twins of the third set of document queries."""

from __future__ import annotations

from quire.plans.reference2_sql import FLAT, _ITEM, places
from quire.plans.reference_sql import EDGES, EL, NODES, P, B, STRIP, count, section

_SEQ = "sq as (select run_id, id, min(seq) as seq from elements_core_content_types_rubric_v1 group by 1, 2)"
_WORDS = "len(list_filter(string_split(trim(regexp_replace({c}, '[ \\t\\r\\n\\f]+', ' ', 'g'), ' '), ' '), lambda x: x <> ''))"
_LABEL = f"""case when kind = 'table' then 'Table' when regexp_full_match(t, '[0-9]{{1,3}}') then 'Section-header' when regexp_matches(t, '\\.{{4,}}[ ]*[0-9]+') then 'List-item' when regexp_matches(t, '^([-*•–]|o|[0-9]{{1,2}}[.)])[ ]') then 'List-item'
  when regexp_matches(t, '[|\\t]') then 'Table' when {count('t', '[A-Za-z]')} >= 4 and length(t) <= 60 and {count('t', '[A-Z]')} >= 0.9 * {count('t', '[A-Za-z]')} and not contains(t, '=') then 'Title' else 'Text' end"""
_SPLIT = "unnest(string_split(text, chr(10)))"

SQL: dict[str, str] = {
    "reduced_elements": f"""with {EL}, r as (select run_id, page, trim(regexp_replace(regexp_replace(regexp_replace(text, '\\r\\n?', chr(10), 'g'), '[ \\t]+', ' ', 'g'), ' ?\\n ?', chr(10), 'g'), ' ') as t from el)
      select run_id, page, count(*) as elements, sum(length(t)) as chars from r where length(t) > 0 group by 1, 2""",
    "gameplay_elements": f"""with {EL}, b as (select run_id, min(page_start) as a, max(page_start) as z from enriched_portions where len(choices) > 0 group by 1)
      select el.run_id, count(*) as elements, count(distinct page) as pages from el join b on b.run_id = el.run_id where page between a and z group by 1""",
    "skipped_blocks": f"""with {EL} select element_key from el where kind in ('header', 'footer', 'image', 'page_number') or regexp_full_match(trim(text, ' '), '[-–~\\[( ]*[0-9]{{1,4}}[-–~\\]) |]*')
      or regexp_matches(trim(text, ' '), '(?i)^(index|appendix|acknowledge?ments|about the author|bibliography|also available)')""",
    "truncated_lines": f"""with {EL}, l as (select element_key, {_SPLIT} as line from el) select element_key, count(*) as lines from l where length(line) >= 60 and not regexp_matches(line, '([.!?:;,"'')\\]-]|\\.\\.\\.|[A-Z])$') group by 1""",
    "wrong_section_numbers": """with p as (select distinct portion_key, section_id, trim(regexp_extract(raw_text, '^([^\\n]*)', 1), ' ') as f from enriched_portions)
      select portion_key from p where regexp_full_match(section_id, '[0-9]+') and regexp_full_match(f, '[0-9]+') and f <> section_id""",
    "gibberish_lines": f"""with l as (select doc_id, {_SPLIT} as line from documents) select doc_id, count(*) as lines from l where length(line) >= 4 and (({count('line', '[A-Za-z]')} / greatest(length(line), 1) < 0.4 and {count('line', '[0-9]')} / greatest(length(line), 1) < 0.5)
      or ({count('line', '[A-Za-z]')} >= 8 and {count('line', '[AEIOUaeiouy]')} = 0)) group by 1""",
    "number_lines_stripped": """with t as (select doc_id, text, array_to_string(list_filter(string_split(text, chr(10)), lambda x: not regexp_full_match(x, '[ ]*[0-9]+[ ]*')), chr(10)) as t from documents where text is not null) select doc_id, length(t) as chars from t where text <> t""",
    "collapsed_blanks": "with t as (select doc_id, text, regexp_replace(text, '\\n{3,}', chr(10) || chr(10), 'g') as t from documents where text is not null) select doc_id, length(t) as chars from t where text <> t",
    "title_candidates": f"""with {EL}, e as (select *, row_number() over (partition by run_id, page order by seq, element_key) - 1 as place, trim(regexp_replace(text, '[ \\t\\r\\n\\f]+', ' ', 'g'), ' ') as t from el where page <= 5 and length(text) <= 80),
        w as (select *, len(string_split(t, ' ')) as w from e),
        s as (select run_id, element_key, seq, case when t = '' or regexp_matches(t, '(?i)^(adventure gamebooks?$|gamebook\\s+[0-9]+$|presents?$|book\\s+[0-9]+$|[0-9]+$)') then 0 else (6 - page) * 10 + (10 - least(place, 9)) * 2
          + case when w between 2 and 5 then 20 when w = 1 then 5 when w <= 10 then 10 else 0 end + case when regexp_matches(t, '^\\p{{Lu}}.*\\p{{Lu}}') then 15 else 0 end + case when length(t) <= 50 then 10 when length(t) <= 100 then 5 else 0 end end as score from w)
      select run_id, element_key, cast(score as int) as score from s qualify row_number() over (partition by run_id order by score desc, seq, element_key) = 1""",
    "section_order": f"""with {NODES} select run_id, section, row_number() over (partition by run_id order by case when section = 'background' then 0 when regexp_full_match(section, '[0-9]+') then 1 else 2 end, try_cast(section as int) nulls first, section) as place from nodes""",
    "boundary_checks": f"""with {B}, {_SEQ}, j as (select b.*, seq from b left join sq on sq.run_id = b.run_id and sq.id = b.start_element_id),
        k as (select *, count(*) over (partition by run_id, section_id) as n1, case when seq is not null then count(*) over (partition by run_id, seq) end as n2 from j),
        e as (select boundary_key, concat_ws(',', case when n1 > 1 then 'duplicate' end, case when seq is null then 'unknown' end, case when n2 > 1 then 'shared' end) as errors from k) select * from e where errors <> ''""",
    "inverted_spans": f"with {B}, {_SEQ} select boundary_key, a.seq as s, z.seq as t from b join sq a on a.run_id = b.run_id and a.id = b.start_element_id join sq z on z.run_id = b.run_id and z.id = b.end_element_id where z.seq < a.seq",
    "duplicate_report": f"with {B} select run_id, section_id, count(*) as candidates, max(confidence) as best, round(max(confidence) - min(confidence), 4) as spread from b group by 1, 2 having count(*) > 1",
    "coverage_by_run": f"""with {NODES}, b as (select distinct run_id, {section('section_id')} as s from section_boundaries_scan), p as (select distinct run_id, {section('section_id')} as s from enriched_portions)
      select n.run_id, count(*) as sections, round(count(b.s) / count(*), 4) as boundaries, round(count(p.s) / count(*), 4) as portions from nodes n left join b on b.run_id = n.run_id and b.s = n.section left join p on p.run_id = n.run_id and p.s = n.section group by 1""",
    "status_bands": f"""with {NODES}, {EDGES}, s as (select e.run_id, round(1 - count(n.section) / count(*), 4) as broken_share from edges e left join nodes n on n.run_id = e.run_id and n.section = e.dst group by 1)
      select *, case when broken_share = 0 then 'clean' when broken_share < 0.1 then 'minor' when broken_share < 0.3 then 'major' else 'critical' end as band from s""",
    "patched_titles": """with b as (select book_id, title, cast(regexp_extract(book_id, '([0-9]+)', 1) as int) as n from books)
      select book_id, case when n % 7 = 0 then 'New ' || title else title end as title from b where n % 10 <> 0 union all select 'bk-new', 'An added book'""",
    "metric_conditions": """with o as (select o_orderpriority, o_totalprice as p, o_orderkey % 6 as k from orders)
      select o_orderpriority, coalesce(case k when 0 then p > 100000 when 1 then p >= 100000 when 2 then p < 100000 when 3 then p <= 100000 when 4 then p = 100000 end, false) as holds, count(*) as orders from o group by 1, 2""",
    "number_tokens": f"with {EL}, t as (select element_key, translate(trim(text, ' '), 'OoDQIl!SsZB', '00001115528') as n from el where length(text) <= 6) select * from t where regexp_full_match(n, '[0-9]+')",
    "page_readings": f"""with {EL}, e as (select run_id, page, sum({_WORDS.format(c='text')}) as element_words from el group by 1, 2), p as (select run_id, page, max({_WORDS.format(c=STRIP.format(c='html'))}) as page_words from pages_html group by 1, 2)
      select coalesce(e.run_id, p.run_id) as run_id, coalesce(e.page, p.page) as page, element_words, page_words, round(element_words / greatest(page_words, 1), 4) as ratio from e full join p on p.run_id = e.run_id and p.page = e.page""",
    "missing_pages": """with e as (select distinct run_id, page from elements_core_content_types_rubric_v1), p as (select distinct run_id, page from pages_html)
      select coalesce(e.run_id, p.run_id) as run_id, coalesce(e.page, p.page) as page, case when e.page is null then 'elements' else 'pages' end as missing_in from e full join p on p.run_id = e.run_id and p.page = e.page where e.page is null or p.page is null""",
    "content_type_votes": f"""with {EL}, s as (select kind, trim(text, ' ') as t, content_type from el where content_type is not null), l as (select kind, {_LABEL} as shape, content_type, count(*) as n from s group by 1, 2, 3)
      select kind, shape, arg_min(content_type, (-n, content_type)) as content_type, max(n) as votes, sum(n) as total, round(max(n) / sum(n), 4) as share from l group by 1, 2""",
    "confidence_histogram": "with e as (select distinct element_key, content_type_confidence as c from elements_core_content_types_rubric_v1 where content_type_confidence is not null) select cast(least(floor(c * 10), 9) as int) as tenth, count(*) as elements from e group by 1",
    "late_rows": " union all ".join(
        f"select run_id, count(*) as late_rows, '{t}' as artifact from (select run_id, loaded_at, min(loaded_at) over (partition by run_id) as f from {t}) where loaded_at > f + interval 1 day group by 1" for t in ("enriched_portions", "gamebook_sections", "section_boundaries_scan")
    ),
    "delivered_copies": " union all ".join(
        f"select count(*) as keys, coalesce(sum(n), 0) as rows, '{t}' as artifact from (select {k}, count(*) as n from {t} group by 1 having count(*) > 1)"
        for t, k in (("enriched_portions", "portion_key"), ("gamebook_sections", "section_key"), ("section_boundaries_scan", "boundary_key"), ("pages_html", "page_key"), ("elements_core_content_types_rubric_v1", "element_key"))
    ),
    "portion_chains": f"""with {P}, o as (select run_id, portion_id, min(section_id) as s from p group by 1, 2) select p.run_id, count(*) as continuations, count(o.s) as resolved from p left join o on o.run_id = p.run_id and o.portion_id = p.continuation_of where p.continuation_of is not null group by 1""",
    "raw_record_fields": """with r as (select distinct raw_key, record from raw_portions), k as (select unnest(case when json_valid(record) and json_type(record) = 'OBJECT' then json_keys(record) else ['(none)'] end) as field from r) select field, count(*) as records from k group by 1""",
    "items_by_section": f"""with {EL}, flats as (select run_id, {FLAT.format(c='text')} as t from el), m as ({places('flats', 'run_id', _ITEM, ['item'])}), e as (select distinct run_id, lower(item) as item from m),
        g as (select distinct run_id, regexp_extract(lower(i), '([a-z-]+)$', 1) as item from (select run_id, unnest(inventory.items_gained) as i from enriched_portions))
      select run_id, item from e where not exists (select 1 from g where g.run_id = e.run_id and g.item = e.item)""",
}
