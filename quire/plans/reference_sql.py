"""SQL twins of the document queries."""

from __future__ import annotations


def section(c: str) -> str:
    """A section as its plain number, or its bare name in lower case."""
    t = f"translate({c}, '０１２３４５６７８９', '0123456789')"
    bare = f"trim(regexp_replace(lower({t}), '[\\s\\x{{00A0}}]+', ' ', 'g'))"
    n = f"regexp_extract({t}, '([0-9]+)', 1)"
    return f"(case when {n} <> '' then regexp_replace({n}, '^0+([0-9])', '\\1') when {bare} <> '' then {bare} end)"


P = """p as (select distinct portion_key, run_id, portion_id, section_id, module_id, page_start, page_end, confidence, continuation_of, continuation_confidence from enriched_portions)"""
B = """b as (select distinct boundary_key, run_id, section_id, start_element_id, end_element_id, start_page, start_line_idx, confidence, method from section_boundaries_scan)"""
# Boundaries in the reading order of their start element; what names no element of its run comes last.
BS = B + """, bs as (select b.*, coalesce(q.seq, 2147483647) as start_seq from b left join (select run_id, id, min(seq) as seq from elements_core_content_types_rubric_v1 group by 1, 2) q on q.run_id = b.run_id and q.id = b.start_element_id)"""
EL = "el as (select distinct element_key, run_id, id, seq, page, page_number, kind, text, content_type from elements_core_content_types_rubric_v1)"
NODES = f"""nodes as (select run_id, {section('section_id')} as section, bool_or(is_gameplay_section) as is_gameplay_section, bool_or(end_game) as end_game
  from gamebook_sections where deleted_at is null group by 1, 2)"""
EDGES = f"""edges as (select distinct run_id, src, {section('t')} as dst from (
    select run_id, {section('section_id')} as src, e.kind as kind, e.targetSection as t from (
      select run_id, section_id, unnest(sequence) as e from gamebook_sections where deleted_at is null))
  where kind = 'choice' and src is not null and {section('t')} is not null)"""
ORPHANS = """orphans as (select run_id, section from nodes n where section not in ({x}) and not exists (
    select 1 from edges e where e.run_id = n.run_id and e.dst = n.section))"""
BROKEN = """broken as (select distinct run_id, dst as section from edges e where regexp_full_match(dst, '[0-9]+') and not exists (
    select 1 from nodes n where n.run_id = e.run_id and n.section = e.dst))"""
STRIP = "trim(regexp_replace(regexp_replace({c}, '<[^>]+>', ' ', 'g'), '[ \\t\\r\\n\\f]+', ' ', 'g'))"
TOKENS = "list_distinct(list_filter(regexp_split_to_array(lower({c}), '[^a-z0-9]+'), lambda x: x <> ''))"


def jaccard(a: str, b: str) -> str:
    return f"(case when len({a}) = 0 or len({b}) = 0 then 0.0 else len(list_intersect({a}, {b})) / len(list_distinct(list_concat({a}, {b}))) end)"


def count(c: str, pattern: str) -> str:
    return f"len(regexp_extract_all({c}, '{pattern}'))"


def ratio(c: str, pattern: str) -> str:
    return f"round({count(c, pattern)} / greatest(length({c}), 1), 4)"


def refs(c: str, pattern: str, low: int = 1, high: int = 400) -> str:
    return f"list_distinct(list_filter(list_transform(regexp_extract_all({c}, '{pattern}', 1), lambda x: cast(x as int)), lambda x: x >= {low} and x <= {high}))"


TURN = "(?i)(?:turn|go|refer)[ ]+to[ ]+([0-9]{1,4})"
ANCHOR = "<a[^>]*href=[\"'']#([0-9]+)[\"'']"
LINES = "list_filter(list_transform(string_split(replace({c}, chr(13), ''), chr(10)), lambda x: trim(x, ' ')), lambda x: x <> '')"
MISSING = """nums as (select run_id, cast(section as int) as n from nodes where regexp_full_match(section, '[0-9]+')),
missing as (select run_id, cast(n as int) as n from (select run_id, unnest(range(1, max(n) + 1)) as n from nums group by run_id) m
  where not exists (select 1 from nums k where k.run_id = m.run_id and k.n = m.n))"""


LONGEST = "(select max(n) from (select count(*) as n from nodes group by run_id))"


def bfs(start: str, src: str, dst: str, depth: str) -> str:
    return f"""with recursive {NODES}, {EDGES},
walk as (select run_id, section as node, 0 as depth from nodes where {start}
  union select w.run_id, e.{dst}, w.depth + 1 from walk w join edges e on e.run_id = w.run_id and e.{src} = w.node where w.depth < {depth})
select run_id, node, min(depth) as depth from walk group by 1, 2"""


SQL: dict[str, str] = {
    "best_occurrence_per_key": f"""with {P} select run_id, section_id, portion_key, page_start, page_end, confidence from p
      qualify row_number() over (partition by run_id, section_id order by confidence desc, page_start desc, page_end - page_start, portion_key) = 1""",
    "resolve_best_occurrence": f"""with {P} select run_id, section_id, portion_key from p
      qualify row_number() over (partition by run_id, section_id order by confidence desc, page_end - page_start desc, page_start, portion_key) = 1""",
    "dedupe_portions_union_sources": f"""with {P} select run_id, section_id, page_start, page_end, arg_min(portion_key, (-confidence, portion_key)) as portion_key, max(confidence) as confidence,
      coalesce(array_to_string(list_sort(list(distinct module_id) filter (module_id is not null)), ','), '') as modules, count(*) as rows from p group by 1, 2, 3, 4""",
    "collapse_duplicate_spans": f"""with {P} select run_id, page_start, page_end, max(confidence) as confidence, count(*) as rows,
      arg_max(continuation_of, (coalesce(continuation_confidence, -1), -portion_key)) filter (continuation_of is not null) as continuation_of from p group by 1, 2, 3""",
    "concat_dedupe_first_wins": f"""with {P}, {B}, u as (select run_id, section_id, boundary_key as row_key, start_page as page, 0 as source_no from b
        union all select run_id, section_id, portion_key, page_start, 1 from p)
      select * from u qualify row_number() over (partition by concat_ws('/', run_id, section_id) order by source_no, row_key) = 1""",
    "overlay_page_numbers": """with a as (select run_id, page, max(page_number) as n from pages_html group by 1, 2), e as (select run_id, page, min(page_number) as n from elements_core_content_types_rubric_v1 group by 1, 2)
      select coalesce(a.run_id, e.run_id) as run_id, coalesce(a.page, e.page) as page, coalesce(e.n, a.n) as page_number from a full join e on a.run_id = e.run_id and a.page = e.page""",
    "unclaimed_links": f"""with {EDGES}, l as (select distinct run_id, {section('section_id')} as src, {section('t')} as dst from (select run_id, section_id, unnest(choices).target as t from enriched_portions))
      select * from l where src is not null and dst is not null and not exists (select 1 from edges e where e.run_id = l.run_id and e.src = l.src and e.dst = l.dst)""",
    "target_hits_misses": f"""with {NODES}, r as (select portion_key, run_id, {section('t')} as section from (select portion_key, run_id, unnest(choices).target as t from (select distinct portion_key, run_id, choices from enriched_portions)))
      select portion_key, count(n.section) as hits, count(*) - count(n.section) as misses from r left join nodes n on n.run_id = r.run_id and n.section = r.section where r.section is not null group by 1""",
    "target_coverage": f"""with {NODES}, {EDGES}, t as (select distinct run_id, dst from edges)
      select t.run_id, count(*) as targets, count(n.section) as found, round(count(n.section) / count(*), 4) as coverage from t left join nodes n on n.run_id = t.run_id and n.section = t.dst group by 1""",
    "missing_in_range": f"with {NODES}, {MISSING} select * from missing",
    "bracket_pages_for_missing": f"""with {NODES}, {MISSING}, k as (select run_id, cast(section_id as int) as n, min(provenance.page) as page from gamebook_sections where deleted_at is null and regexp_full_match(section_id, '[0-9]+') group by 1, 2)
      select run_id, n, (select arg_max(page, k.n) from k where k.run_id = m.run_id and k.n < m.n and page is not null) as below,
        (select arg_min(page, k.n) from k where k.run_id = m.run_id and k.n > m.n and page is not null) as above from missing m""",
    "span_flagged_pages": f"""with {P}, f as (select distinct run_id, page, length({STRIP.format(c="html")}) as chars from pages_html)
      select portion_key, count(distinct page) as flagged_pages, min(chars) as least_chars from p join f on f.run_id = p.run_id and f.page between p.page_start and p.page_end where chars < 400 group by 1""",
    "macro_section_of_boundary": f"""with {B}, e as (select run_id, id, min(seq) as seq from elements_core_content_types_rubric_v1 group by 1, 2),
        m as (select distinct run_id, m.id as id, m.start_seq as s, m.end_seq as t from (select run_id, unnest(macro_sections) as m from sections_structured_stub))
      select boundary_key, arg_min(m.id, (t - s, m.id)) as macro_id from b join e on e.run_id = b.run_id and e.id = b.start_element_id join m on m.run_id = b.run_id and e.seq between s and t group by 1""",
    "merge_fine_coarse_spans": f"""with {P}, fine as (select * from p where confidence >= 0.8), coarse as (select * from p where confidence < 0.8),
        cp as (select portion_key, run_id, unnest(range(page_start, page_end + 1)) as page from coarse),
        ok as (select portion_key from cp c group by portion_key having round(avg(case when exists (select 1 from fine f where f.run_id = c.run_id and c.page between f.page_start and f.page_end) then 0.0 else 1.0 end), 4) >= 0.5)
      select run_id, portion_key, page_start, page_end, 'fine' as origin from fine
      union all select run_id, portion_key, page_start, page_end, 'coarse' from coarse where portion_key in (select portion_key from ok)""",
    "preference_merge_boundaries": f"""with {B} select run_id, section_id, boundary_key from b where exists (select 1 from elements_core_content_types_rubric_v1 e where e.run_id = b.run_id and e.id = b.start_element_id)
      qualify row_number() over (partition by run_id, section_id order by (method is null), confidence desc, boundary_key) = 1""",
    "page_elements_vs_html": f"""with a as (select run_id, page, {TOKENS.format(c="string_agg(text, ' ')")} as a from elements_core_content_types_rubric_v1 group by 1, 2),
        g as (select run_id, page, {TOKENS.format(c=STRIP.format(c="arg_max(html, page_key)"))} as b from pages_html where html is not null group by 1, 2)
      select run_id, page, round({jaccard('a', 'b')}, 4) as overlap from a join g using (run_id, page) where round({jaccard('a', 'b')}, 4) < 0.9""",
    "boundary_spans_next_start": f"with {BS} select boundary_key, run_id, section_id, start_element_id, lead(start_element_id) over (partition by run_id order by start_seq, boundary_key) as next_start from bs",
    "header_body_score": f"""with {EL}, h as (select *, regexp_full_match(trim(text), '[0-9]{{1,3}}') as h from el where text is not null), n as (select *, sum(h::int) over (partition by run_id order by seq rows unbounded preceding) as header_no from h)
      select run_id, header_no, coalesce(sum(least(200, length(text))) filter (not h), 0) as score, count(*) filter (not h) as body_rows from n where header_no > 0 group by 1, 2""",
    "keep_earliest_within_50": f"""with {BS}, s as (select *, cast(trunc(confidence * 1000) as int) as score from bs), t as (select *, max(score) over (partition by run_id, section_id) as top from s)
      select run_id, section_id, boundary_key, score from t where score >= top - 50 qualify row_number() over (partition by run_id, section_id order by start_seq, boundary_key) = 1""",
    "pattern_regions": """with m as (select run_id, page, max(coalesce(content_type in ('Page-header', 'Page-footer'), false)::int) as marked from elements_core_content_types_rubric_v1 group by 1, 2),
        c as (select *, coalesce((marked <> lag(marked) over (partition by run_id order by page))::int, 1) as fresh from m), i as (select *, sum(fresh) over (partition by run_id order by page) as region from c)
      select run_id, region, marked, min(page) as first_page, max(page) as last_page, count(*) as pages from i group by 1, 2, 3""",
    "page_number_inference": """with p as (select run_id, page, max(page_number) as page_number from pages_html group by 1, 2), i as (select *, row_number() over (partition by run_id order by page) as i from p),
        k as (select *, last_value(case when page_number is not null then i end ignore nulls) over w as bi, last_value(page_number ignore nulls) over w as bn,
              first_value(case when page_number is not null then i end ignore nulls) over v as ai, first_value(page_number ignore nulls) over v as an from i
              window w as (partition by run_id order by page rows between unbounded preceding and current row), v as (partition by run_id order by page rows between current row and unbounded following))
      select run_id, page, page_number, case when page_number is not null then page_number when bi is not null and ai is not null then case when an - bn = ai - bi then bn + i - bi end
        when bi is not null then bn + i - bi when ai is not null and an - (ai - i) >= 1 then an - (ai - i) end as inferred from k""",
    "ordering_conflicts": f"""with {BS}, n as (select *, cast(section_id as int) as n from bs where regexp_full_match(section_id, '[0-9]+')), l as (select *, lag(n) over (partition by run_id order by start_seq, boundary_key) as previous from n)
      select boundary_key, n, previous from l where n < previous""",
    "section_run_lengths": """with n as (select distinct run_id, start_page, cast(section_id as int) as n from section_boundaries_scan where regexp_full_match(section_id, '[0-9]+') and start_page is not null),
        g as (select *, n - row_number() over (partition by run_id, start_page order by n) as g from n)
      select run_id, start_page, n, count(*) over (partition by run_id, start_page, g) as run_length from g""",
    "sliding_page_windows": """with p as (select run_id, page, row_number() over (partition by run_id order by page) - 1 as i from (select distinct run_id, page from pages_html)),
        w as (select run_id, max(i) as top from p group by 1), s as (select run_id, unnest(range(0, cast(top // 5 + 1 as bigint))) as k from w)
      select s.run_id, k as window_no, min(page) as first_page, max(page) as last_page, count(*) as pages from s join p on p.run_id = s.run_id and i >= 5 * k and i < 5 * k + 8 group by 1, 2""",
    "top_portions_per_page": f"""with {P}, r as (select *, row_number() over (partition by run_id, page_start order by confidence desc, portion_key) as rank from p) select run_id, page_start, rank, portion_key from r where rank <= 2""",
    "page_clusters": """with p as (select distinct run_id, page_start as page from enriched_portions where len(combat) > 0), g as (select *, page - row_number() over (partition by run_id order by page) as g from p),
        c as (select run_id, g, min(page) as a, max(page) as z from g group by 1, 2)
      select run_id, row_number() over (partition by run_id order by a) as cluster, a as first_page, z as last_page from c""",
    "interleave_by_run": f"with {P} select portion_key, run_id, row_number() over (partition by run_id order by page_start, portion_key) as turn from p",
    "continuation_links": f"""with q as (select distinct portion_key, run_id, coalesce(raw_text, '') as title, page_start, page_end, confidence from enriched_portions),
        l as (select *, {TOKENS.format(c="title")} as t, lag(portion_key) over w as pk, lag({TOKENS.format(c="title")}) over w as pt, lag(page_end) over w as pe, lag(confidence) over w as pc from q window w as (partition by run_id order by page_start, portion_key)),
        s as (select portion_key, pk as previous_key, round(0.5 * {jaccard('t', 'pt')} + case when page_start - pe <= 1 then 0.3 else 0 end + 0.2 * (confidence + pc) / 2, 6) as score from l where pk is not null)
      select * from s where score >= 0.55""",
    "boundary_gap_check": f"""with {B}, s as (select distinct b.run_id, e.seq from b join elements_core_content_types_rubric_v1 e on e.run_id = b.run_id and e.id = b.start_element_id), l as (select *, lag(seq) over (partition by run_id order by seq) as previous from s)
      select * from l where seq - previous > 20""",
    "incoming_references": f"with {EDGES} select run_id, dst, count(*) as \"references\", count(distinct src) as sources from edges group by 1, 2",
    "orphan_sections": f"with {NODES}, {EDGES}, {ORPHANS.format(x="'1', 'background', 'intro', 'rules'")} select * from orphans",
    "broken_links": f"with {NODES}, {EDGES}, {BROKEN} select * from broken",
    "reachable_sections": bfs("section in ('1', 'background')", "src", "dst", LONGEST),
    "reverse_paths_to_end": bfs("end_game", "dst", "src", "20"),
    "orphan_confusions": f"""with {NODES}, {EDGES}, {ORPHANS.format(x="'1', 'background'")},
        c(a, b) as (values ('0', '9'), ('9', '0'), ('6', '8'), ('8', '6'), ('8', '3'), ('3', '8'), ('1', '7'), ('7', '1'), ('5', '6'), ('2', '7')),
        o as (select run_id, section, unnest(range(1, length(section) + 1)) as i from orphans where regexp_full_match(section, '[0-9]+')),
        m as (select distinct run_id, section, substr(section, 1, i - 1) || b || substr(section, i + 1) as dst from o join c on c.a = substr(section, i, 1))
      select run_id, section, dst from m where dst not like '0%' and exists (select 1 from edges e where e.run_id = m.run_id and e.dst = m.dst)""",
    "no_choice_sections": """select distinct section_key, run_id, section_id from gamebook_sections where is_gameplay_section and not end_game and deleted_at is null
      and not coalesce(len(list_filter(sequence, lambda e: e.kind = 'choice' and e.targetSection is not null and trim(e.targetSection) <> '')) > 0, false)
      and not coalesce(len(list_filter(sequence, lambda e: e.outcomes.win.targetSection is not null or e.outcomes.lose.targetSection is not null)) > 0, false)""",
    "duplicate_sections": "select run_id, section_id, count(distinct section_key) as keys from gamebook_sections group by 1, 2 having count(distinct section_key) > 1",
    "empty_sections": f"select distinct section_key from gamebook_sections where {STRIP.format(c='html')} = ''",
    "outcome_targets": f"""with {NODES}, e as (select run_id, section_key, unnest(sequence) as e from gamebook_sections where deleted_at is null),
        t as (select run_id, section_key, unnest([e.outcomes.win.targetSection, e.outcomes.lose.targetSection]) as t from e where e.kind = 'combat'), k as (select distinct run_id, section_key, {section('t')} as section from t)
      select run_id, section, section_key from k where section is not null and not exists (select 1 from nodes n where n.run_id = k.run_id and n.section = k.section)""",
    "section_range": f"""with {NODES} select run_id, min(cast(section as int)) as low, max(cast(section as int)) as high, count(*) as sections,
      round(count(*) / (max(cast(section as int)) - min(cast(section as int)) + 1), 4) as completeness from nodes where regexp_full_match(section, '[0-9]+') group by 1""",
    "quality_vector": f"""with t as (select doc_id, text, list_filter(string_split(trim(regexp_replace(text, '[ \\t\\r\\n\\f]+', ' ', 'g'), ' '), ' '), lambda w: w <> '') as w, {LINES.format(c="text")} as l from documents where text is not null)
      select doc_id, length(text) as chars, {ratio('text', '[A-Za-z]')} as alpha, {ratio('text', '[0-9]')} as digits, round(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) / greatest(len(w), 1), 4) as mean_word,
        case when len(l) = 0 then 0 else round(1 - len(list_distinct(l)) / len(l), 4) end as dup_lines from t""",
    "garble_reasons": f"""with t as (select doc_id, coalesce(text, '') as text from documents), r as (select doc_id, concat_ws(',', case when length(text) < 40 then 'short' end, case when {ratio('text', '[A-Za-z\\p{L}]')} < 0.5 then 'low_alpha' end,
        case when {ratio('text', '[0-9]')} > 0.3 then 'digit_heavy' end, case when contains(text, chr(65533)) then 'replacement_char' end) as reasons from t) select * from r where reasons <> ''""",
    "corruption_scores": f"""with s as (select doc_id, round(greatest(0.6 * least(1.0, {count('text', '[|][0-9]|[0-9][|]')} / 5.0), 0.8 * least(1.0, {count('text', '[^A-Za-z0-9 \\t\\r\\n]{3,}')} / 10.0),
        case when length(text) >= 40 then greatest(0.0, 0.6 - {ratio('text', '[A-Za-z]')}) else 0.0 end), 4) as score from documents where text is not null) select * from s where score > 0""",
    "fragmented_pages": f"""with {EL}, l as (select element_key, list_transform({LINES.format(c="text")}, lambda x: length(x)) as l from el)
      select element_key from l where len(l) >= 3 and len(list_filter(l, lambda v: v < 15)) / len(l) > 0.5 and list_sum(l) / len(l) < 20""",
    "turn_to_refs": f"select doc_id, unnest({refs('text', TURN)}) as target from documents",
    "html_anchor_edges": f"select distinct page_key, unnest({refs('html', ANCHOR, 1, 9999)}) as target from pages_html",
    "html_stats": "select distinct page_key, " + ", ".join(f"{count('html', f'<{t}[ >]')} as \"{t}\"" for t in ("table", "tr", "td", "h2", "p", "li", "img")) + " from pages_html",
    "header_numbers": "select distinct page_key, cast(n as int) as n from (select page_key, unnest(regexp_extract_all(html, '<h2>[ ]*([0-9]{1,4})[ ]*</h2>', 1)) as n from pages_html)",
    "choice_patterns_vs_anchors": f"""with q as (select distinct portion_key, raw_text, choices from enriched_portions), r as (select portion_key, unnest({refs("coalesce(raw_text, '')", TURN)}) as target from q),
        c as (select portion_key, try_cast({section('t')} as int) as target from (select portion_key, unnest(choices).target as t from q))
      select portion_key, target from r where not exists (select 1 from c where c.portion_key = r.portion_key and c.target = r.target)""",
    "normalized_targets": f"""with w as (select distinct t as written from (select unnest(choices).target as t from enriched_portions) where t is not null), k as (select written, translate(trim(written, ' '), 'OoDQIl!SsZB', '00001115528') as x from w)
      select written, {section('written')} as section, case when regexp_full_match(x, '[0-9]+') then x end as digits_only from k""",
    "element_labels": f"""with {EL}, t as (select trim(text, ' ') as t, kind, coalesce(content_type, '') as given from el),
        l as (select given, case when kind = 'table' then 'Table' when regexp_full_match(t, '[0-9]{{1,3}}') then 'Section-header' when regexp_matches(t, '\\.{{4,}}[ ]*[0-9]+') then 'List-item' when regexp_matches(t, '^([-*•–]|o|[0-9]{{1,2}}[.)])[ ]') then 'List-item'
          when regexp_matches(t, '[|\\t]') then 'Table' when {count('t', '[A-Za-z]')} >= 4 and length(t) <= 60 and {count('t', '[A-Z]')} >= 0.9 * {count('t', '[A-Za-z]')} and not contains(t, '=') then 'Title' else 'Text' end as label from t)
      select label, given, count(*) as rows from l group by 1, 2""",
    "all_caps_headings": f"""with {EL}, t as (select element_key, trim(text, ' ') as t from el) select element_key from t where {count('t', '[A-Za-z]')} >= 4 and length(t) <= 60 and {count('t', '[A-Z]')} >= 0.9 * {count('t', '[A-Za-z]')} and not contains(t, '=')""",
    "reflowed_elements": f"""with {EL}, r as (select element_key, text, regexp_replace(text, '([A-Za-z])-[ ]*\\r?\\n[ ]*([a-z])', '\\1\\2', 'g') as x from el) select element_key, length(x) as chars, md5(x) as digest from r where text <> x""",
    "toc_entries": f"""with {EL}, l as (select unnest(string_split(text, chr(10))) as l from el), m as (select regexp_extract(l, '^(.*?)[ ]*\\.{{3,}}[ ]*([0-9]+)[ ]*$', 1) as t, regexp_extract(l, '^(.*?)[ ]*\\.{{3,}}[ ]*([0-9]+)[ ]*$', 2) as page from l)
      select regexp_replace(regexp_replace(lower(trim(t)), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') as title, min(cast(page as int)) as page, count(*) as entries from m where page <> '' group by 1""",
    "ending_kinds": "select distinct section_key, case when regexp_matches(lower(html), 'victor|triumph|success|congratulations|you have won') then 'victory' else 'death' end as ending from gamebook_sections where end_game",
    "vocabulary_ratio": f"""with w as (select doc_id, unnest({TOKENS.format(c="coalesce(text, '')")}) as w from documents), k as (select distinct lower(word) as w from word_list)
      select doc_id, count(*) as words, round(count(k.w) / count(*), 4) as in_vocabulary from w left join k on k.w = w.w group by 1""",
    "neighbour_similarity": f"""with t as (select doc_id, source, {TOKENS.format(c="text")} as t from documents where text is not null), p as (select *, lag(t) over (partition by source order by doc_id) as p from t)
      select doc_id, round({jaccard('t', 'p')}, 4) as similarity from p where p is not null and round({jaccard('t', 'p')}, 4) >= 0.3""",
    "duplicate_documents": "select doc_id, class_id, copies from (select doc_id, min(doc_id) over w as class_id, count(*) over w as copies from documents where text is not null window w as (partition by text)) where copies > 1",
    "issue_counts": """with i as (select report_key, unnest(issues) as i from (select distinct report_key, issues from pipeline_issues))
      select coalesce(json_extract_string(i, '$.type'), json_extract_string(i, '$.kind'), '?') as kind, count(*) as issues, count(distinct report_key) as reports from i group by 1""",
    "run_health": f"""with {NODES}, {EDGES}, {ORPHANS.format(x="'1', 'background'")}, {BROKEN}, n as (select run_id, count(*) as sections from nodes group by 1), o as (select run_id, count(*) as orphans from orphans group by 1), k as (select run_id, count(*) as broken from broken group by 1)
      select n.run_id, sections, coalesce(orphans, 0) as orphans, coalesce(broken, 0) as broken, case when coalesce(orphans, 0) = 0 and coalesce(broken, 0) = 0 then 'healthy' when coalesce(broken, 0) > 0 then 'broken' else 'orphans' end as status
      from n left join o on o.run_id = n.run_id left join k on k.run_id = n.run_id""",
    "cost_rollup": """with u as (select l_returnflag, round((l_quantity * coalesce(p_size / 100.0, 0.01) + round(l_extendedprice / 100) * coalesce(p_retailprice / 10000, 0.03)) / 1000, 6) as cost
        from lineitem left join (select * from part where p_partkey % 3 > 0) p on p_partkey = l_partkey)
      select coalesce(l_returnflag, 'all') as l_returnflag, count(*) as calls, round(sum(cost), 2) as cost from u group by rollup (l_returnflag)""",
    "model_ranking": """with s as (select l_suppkey as model, round(avg(1 - l_discount), 6) as quality, round(avg(l_quantity), 6) as latency, round(avg(l_extendedprice) / 1000, 6) as cost from lineitem group by 1), b as (select min(latency) as f, min(cost) as c from s)
      select model, quality, latency, cost, round(0.60 * quality + 0.25 * f / latency + 0.15 * c / cost, 4) as score from s, b where not exists (select 1 from s r where r.quality >= s.quality and r.latency <= s.latency and r.cost <= s.cost
        and (r.quality > s.quality or r.latency < s.latency or r.cost < s.cost))""",
    "state_fold": "select user_id, event_type, arg_max(event_id, (ts, event_id)) as event_id, arg_max(value, (ts, event_id)) as value, count(*) as events from events group by 1, 2",
    "box_overlaps": """with b as (select vec_id, list_transform(embedding, lambda x: abs(cast(x as double))) as v from embeddings), c as (select vec_id, v, greatest(0.0, least(v[1] + v[3], v[5] + v[7]) - greatest(v[1], v[5])) as w, greatest(0.0, least(v[2] + v[4], v[6] + v[8]) - greatest(v[2], v[6])) as h from b)
      select vec_id, round(case when v[3] * v[4] + v[7] * v[8] - w * h > 0 then w * h / (v[3] * v[4] + v[7] * v[8] - w * h) else 0 end, 4) as overlap from c""",
    "macro_confidence": "select run_id, count(*) as sections, round(avg(m.confidence), 4) as confidence, max(m.end_seq - m.start_seq + 1) as widest from (select run_id, unnest(macro_sections) as m from (select distinct structure_key, run_id, macro_sections from sections_structured_stub)) group by 1",
    "stat_check_targets": f"select distinct portion_key, s.stat as stat, {section('s.pass_section')} as pass_section, {section('s.fail_section')} as fail_section from (select portion_key, unnest(stat_checks) as s from enriched_portions) where s is not null",
    "inventory_balance": """with q as (select distinct portion_key, run_id, inventory from enriched_portions), i as (select run_id, unnest(inventory.items_gained) as item, 1 as n from q union all select run_id, unnest(inventory.items_lost), -1 from q)
      select run_id, lower(trim(item, ' ')) as item, sum(n) as balance, count(*) as events from i where item is not null group by 1, 2""",
}
