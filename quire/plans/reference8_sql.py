"""SQL twins of the eighth set of document queries."""

from __future__ import annotations

from quire.plans.reference2_sql import SQL as SECOND
from quire.plans.reference6_sql import _READ
from quire.plans.reference_sql import B, EL, MISSING, NODES, count

_BOUNDS = "bd as (select run_id, min(page_start) as a, max(page_start) as z from enriched_portions where len(choices) > 0 group by 1)"
_KINDS = {"Title": "heading", "Header": "header", "Footer": "footer", "Table": "table", "ListItem": "list", "Image": "image", "PageNumber": "page_number", "FigureCaption": "caption"}

SQL: dict[str, str] = {
    "element_kinds": f"with {EL} select case replace(content_type, '-', '') " + " ".join(f"when '{k}' then '{v}'" for k, v in _KINDS.items()) + " else 'text' end as kind, count(*) as elements from el group by 1",
    "section_header_elements": f"""with {EL}, {_BOUNDS}, e as (select *, try_cast(trim(text, ' ') as int) as n from el where content_type = 'Section-header' and regexp_full_match(trim(text, ' '), '[0-9]+'))
      select element_key, e.run_id, n from e join bd on bd.run_id = e.run_id where n between 1 and 400 and page between a and z""",
    "frontmatter_elements": f"with {EL}, {_BOUNDS} select el.run_id, count(*) as elements, sum(length(text)) as chars from el join bd on bd.run_id = el.run_id where page < a group by 1",
    "title_heads": """with e as (select distinct element_key, run_id, book_id, page, lower(trim(regexp_replace(text, '[ \\t\\r\\n\\f]+', ' ', 'g'), ' ')) as line from elements_core_content_types_rubric_v1 where length(text) <= 80)
      select run_id, count(*) as heads, count(distinct page) as pages from e join books b on b.book_id = e.book_id and lower(trim(regexp_replace(b.title, '[ \\t\\r\\n\\f]+', ' ', 'g'), ' ')) = e.line group by 1""",
    "prefix_dropped": f"""with {EL}, j as (select element_key, concat_ws(chr(10), text, lead(text) over (partition by run_id order by seq, element_key)) as two from el), r as (select *, regexp_replace(two, '^[ ]*[0-9]+[ ]*\\n', '') as rest from j)
      select element_key, length(rest) as chars from r where two <> rest""",
    "portions_to_repair": _READ.split("r2 as")[0].replace(_READ.split("r1 as")[0], "with k as (select list(distinct lower(word)) as known from word_list), ").split("r1 as")[0]
    + "r1 as (select portion_key, raw_text as text, known from (select distinct portion_key, raw_text from enriched_portions where length(trim(raw_text, ' ')) >= 60), k), r2 as"
    + _READ.split("r2 as")[1]
    + " select portion_key, words, dictionary, confusion from sp where dictionary >= 0.5 or confusion >= 0.5",
    "suspected_pages": f"""with {NODES}, {MISSING}, {B}, f as (select run_id, cast(section_id as int) as n, min(start_page) as page from b where regexp_full_match(section_id, '[0-9]+') and start_page is not null and not exists (select 1 from missing m where m.run_id = b.run_id and m.n = cast(b.section_id as int)) group by 1, 2),
        k as (select run_id, n, (select arg_max(page, f.n) from f where f.run_id = m.run_id and f.n < m.n) as below, (select arg_min(page, f.n) from f where f.run_id = m.run_id and f.n > m.n) as above from missing m),
        p as (select run_id, unnest(range(below, above + 1)) as page from k where above >= below and above - below <= 20)
      select run_id, cast(page as int) as page, count(*) as missing from p group by 1, 2""",
    "drift_groups": f"""with p as (select distinct page_key, case when {count('html', '<thead')} > 0 then 'head' else 'plain' end || '/' || case when {count('html', '<th[ >]')} > 0 then 'th' else 'td' end as signature from pages_html), c as ({SECOND['chapter_drift']})
      select signature, count(*) as pages, arg_min(page_key, (drift, page_key)) as baseline, min(drift) as baseline_drift, sum((drift >= 20)::int) as flagged from p join c using (page_key) group by 1""",
}
