"""SQL twins of the fourth set of document queries."""

from __future__ import annotations

from quire.plans.problems_sql import _inner, _there, _things
from quire.plans.reference_sql import P, SQL as FIRST, STRIP

_EVIDENCE = (
    ("anchor", "<a[^>]*href=[\"'']#([0-9]+)[\"'']", 1.0), ("turn_to", "(?i)turn[ ]+to[ ]+(?:section[ ]+|page[ ]+)?([0-9]{1,4})", 0.95), ("go_to", "(?i)go[ ]+to[ ]+(?:section[ ]+)?([0-9]{1,4})", 0.9),
    ("refer_to", "(?i)refer[ ]+to[ ]+([0-9]{1,4})", 0.85), ("lies_weiter", "(?i)lies[ ]+weiter[ ]+bei[ ]+([0-9]{1,4})", 0.95), ("rendez_vous", "(?i)rendez-vous[ ]+au[ ]+([0-9]{1,4})", 0.95), ("pasa_al", "(?i)pasa[ ]+al[ ]+([0-9]{1,4})", 0.95),
)
_C = "pg as (select distinct page_key, html, " + STRIP.format(c="html") + " as t from pages_html), c0 as (" + " union all ".join(
    f"select page_key, cast(unnest(regexp_extract_all({'html' if n == 'anchor' else 't'}, '{p}', 1)) as int) as target, '{n}' as evidence, cast({c} as double) as confidence, {i} as o from pg" for i, (n, p, c) in enumerate(_EVIDENCE)
) + "), c as (select * from c0 where evidence = 'anchor' or target between 1 and 400)"

SQL: dict[str, str] = {
    "page_choices": f"with {_C} select page_key, target, arg_min(evidence, (-confidence, o)) as evidence, max(confidence) as confidence from c group by 1, 2",
    "choice_evidence": f"with {_C} select evidence, count(*) as matches, count(distinct page_key) as pages from c group by 1",
    "anchor_variants": f"""with {_C}, a as (select distinct page_key, target as anchor from c where evidence = 'anchor'), t as (select distinct page_key, target from c where evidence <> 'anchor' and (page_key, target) not in (select (page_key, anchor) from a))
      select distinct t.page_key, target, anchor from t join a on a.page_key = t.page_key where levenshtein(cast(target as varchar), cast(anchor as varchar)) = 1""",
    "escalation_budget": f"select * from ({FIRST['page_elements_vs_html']}) order by overlap, run_id, page limit 20",
    "sampled_pages": """with p as (select run_id, page, row_number() over (partition by run_id order by page) - 1 as i, count(*) over (partition by run_id) as n from (select distinct run_id, page from pages_html)), s as (select *, greatest(1, n // 5) as step from p)
      select run_id, page from s where i % step = 0 and i // step < 5""",
    "portion_page_windows": f"""with {P}, w as (select run_id, page_start, unnest(range(cast(greatest(0, floor((page_start - 10) / 5) + 1) as bigint), cast(floor(page_start / 5) + 1 as bigint))) as w from p)
      select run_id, w, count(*) as portions, min(page_start) as first_page, max(page_start) as last_page from w group by 1, 2""",
    "weighted_reasons": f"""with i as (select distinct report_key, summary from pipeline_issues where json_valid(summary)),
        f as (select report_key, {_inner('c')} as c from (select report_key, json_extract(cast(summary as json), '$.flagged_genealogy_chapters') as c from i)),
        c as (select report_key, x.v as v from (select report_key, unnest({_things('c')}) as x from f) where {_there('x.v')}),
        r as (select report_key, json_extract(v, '$.reasons') as r from c where json_type(v) = 'OBJECT'), s as (select x.v as v from (select unnest({_things('r')}) as x from r) where {_there('x.v')})
      select json_extract_string(v, '$') as reason, count(*) as chapters from s where json_type(v) = 'VARCHAR' group by 1 order by chapters desc, reason limit 20""",
}
