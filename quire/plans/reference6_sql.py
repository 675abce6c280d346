"""SQL twins of the sixth set of document queries."""

from __future__ import annotations

from quire.plans.reference_sql import BS, EL, P, B, STRIP, count, section

_N = "n as (select *, cast(section_id as int) as n from {t} where regexp_full_match(section_id, '[0-9]+') and start_page is not null)"
_FILLED = "list_filter(list_transform(coalesce(lines, []), lambda x: trim(x, ' ')), lambda x: x <> '')"
_FRAGMENT = "(length(trim({x}, ' ')) between 1 and 3 and not regexp_full_match(trim({x}, ' '), '[0-9]+') and not regexp_full_match(trim({x}, ' '), '[A-Z]{{1,2}}') and lower(trim({x}, ' ')) not in ({w}))"
_SHORT = ", ".join(f"'{w}'" for w in "a i to of in it is be as at he we so do if my me up go no us am an or by on".split())
_FORM = "SKILL STAMINA LUCK EQUIPMENT ITEMS GOLD PROVISIONS JEWELS POTIONS ADVENTURE SHEET MONSTER ENCOUNTER BOXES CARRIED".split()
_LINES = f"pl as (select run_id, page, flatten(list(string_split(text, chr(10)) order by seq, element_key)) as lines from el where text is not null group by 1, 2)"
_LATEST = "lp as (select run_id, page, arg_max(html, page_key) as html from pages_html where html is not null group by 1, 2)"
_HTML_LINES = "trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '</(?:p|h[1-6]|li|tr|dt|dd)>|<br>', chr(10), 'g'), '<[^>]+>', ' ', 'g'), '[ \\t\\r\\f]+', ' ', 'g'), ' ?\\n ?', chr(10), 'g'), ' ')"
_READ = f"""{_LINES}, {_LATEST}, rd as (select run_id, page, 'elements' as engine, 0 as preference, lines from pl
  union all select run_id, page, 'pages', 1, list_filter(string_split({_HTML_LINES}, chr(10)), lambda x: x <> '') from lp),
k as (select list(distinct lower(word)) as known from word_list), r1 as (select run_id, page, engine, preference, lines, array_to_string(lines, chr(10)) as text, known from rd, k),
r2 as (select *, regexp_extract_all(lower(text), '[a-z]+') as w, list_filter(regexp_split_to_array(text, '[ \t\r\n\f\v]+'), lambda t: t <> '') as t from r1),
r3 as (select *, list_filter(w, lambda x: not list_contains(known, x) and not (ends_with(x, 's') and ((length(x) > 3 and list_contains(known, x[:-2])) or (ends_with(x, 'es') and length(x) > 3 and list_contains(known, x[:-3]))
    or (ends_with(x, 'ies') and length(x) > 4 and list_contains(known, x[:-4] || 'y'))))) as u,
  list_filter(list_transform(list_filter(t, lambda x: regexp_matches(x, '[A-Za-z]') and regexp_matches(x, '[0-9]')), lambda x: regexp_replace(x, '^[.,;:!?()\\[\\]{{}}<>"'']+|[.,;:!?()\\[\\]{{}}<>"'']+$', '', 'g')), lambda x: not regexp_full_match(x, '(?i)[0-9]+(st|nd|rd|th)')) as m from r2),
sp as (select *, len(w) as words, round(least(1.0, greatest(len(u) / greatest(len(w), 1), case when len(list_filter(u, lambda x: length(x) >= 4 and not regexp_matches(x, '[aeiouy]'))) > 0 then 0.5 else 0.0 end)), 4) as dictionary,
  round(least(1.0, greatest(2 * len(list_filter(m, lambda x: length(x) >= 3)) / greatest(len(t), 1), case when len(list_filter(m, lambda x: length(x) >= 4 and regexp_matches(x, '[0134579]'))) > 0 then 0.6
    when len(list_filter(m, lambda x: length(x) >= 2 and list_contains(known, translate(lower(x), '0134579', 'oleastg')))) > 0 then 0.5 else 0.0 end)), 4) as confusion from r3)"""
_OPTIONS = {**{str(i): [str(i)] for i in range(10)}, "o": ["0"], "O": ["0"], "l": ["1", "8"], "I": ["1"], "i": ["1"], "b": ["6", "8"], "B": ["8"], "g": ["9"], "q": ["9"], "s": ["5", "8"], "S": ["5", "8"], "z": ["2"],
            ":": ["", "1", "2"], ".": [""], "'": [""], "`": [""], '"': [""], "-": [""], "–": [""], "—": [""], "%": ["", "2"]}
_CASE = "case c " + " ".join("when '{}' then [{}]".format(k.replace("'", "''"), ", ".join(f"'{x}'" for x in v)) for k, v in _OPTIONS.items()) + " end"
_BESIDE = ("(?i)\\bin\\s+([0-9]+)", "(?i)\\bm\\s+([0-9]+)", "(?i)\\b[a-zA-Z]+\\s*([0-9]{1,3})\\b", "(?i)\\b([0-9]{1,3})\\s*[a-zA-Z]+\\b")
_CUTS = ", ".join(f"case when regexp_matches(text, '{p}') and trim(regexp_replace(text, '{p}', '\\1', 'g'), ' ') <> '' then trim(regexp_replace(text, '{p}', '\\1', 'g'), ' ') end" for p in _BESIDE)

SQL: dict[str, str] = {
    "page_outliers": f"""with {B}, {_N.format(t='b')}, e as (select run_id, min(start_page) as lo, max(start_page) as hi from n group by 1),
        l as (select boundary_key, run_id, start_page, n, coalesce((n - lag(n) over w > 5)::int, 1) as fresh from n window w as (partition by run_id, start_page order by n, boundary_key)),
        c as (select *, sum(fresh) over (partition by run_id, start_page order by n, boundary_key) as cluster from l),
        s as (select c.run_id, start_page, cluster, count(*) as size, min(n) as first, abs(avg(n) - floor(case when any_value(hi) = any_value(lo) then 0.5 else (start_page - any_value(lo)) / (any_value(hi) - any_value(lo)) end * 400)) as off
          from c join e on e.run_id = c.run_id group by 1, 2, 3),
        x as (select run_id, start_page, list_reduce(list({{'off': off, 'cluster': cluster}} order by -size, first), lambda a, b: case when b.off * 3 < a.off then b else a end).cluster as cluster from s group by 1, 2)
      select boundary_key, run_id, start_page, n from c join x using (run_id, start_page, cluster)""",
    "resolved_duplicates": f"""with {BS}, {_N.format(t='bs')}, d as (select distinct run_id, start_page, n from n), g as (select *, n - row_number() over (partition by run_id, start_page order by n) as g from d),
        f as (select run_id, start_page, n, count(*) over (partition by run_id, start_page, g) as fit from g)
      select run_id, n, boundary_key, fit from n join f using (run_id, start_page, n) qualify row_number() over (partition by run_id, n order by fit desc, start_seq, boundary_key) = 1""",
    "centred_boxes": """with e as (select label, (abs(cast(embedding[1] as double)) + abs(cast(embedding[2] as double))) / 2 as c from embeddings), s as (select label, avg(c) as m, stddev_samp(c) as s from e group by 1)
      select label, count(*) as boxes, sum((abs(c - m) <= case when s is null then 0.05 else greatest(0.02, 2 * s) end)::int) as centred from e join s using (label) group by 1""",
    "column_splits": """with e as (select distinct element_key, run_id, page, layout.y as x from elements_core_content_types_rubric_v1 where layout.y is not null), g as (select run_id, page, x, row_number() over w as "left", lead(x) over w as nx, count(*) over (partition by run_id, page) as lines
          from e window w as (partition by run_id, page order by x, element_key)),
        b as (select *, round(nx - x, 6) as gap from g where nx is not null and lines >= 6 qualify row_number() over (partition by run_id, page order by round(nx - x, 6) desc, "left") = 1)
      select run_id, page, round((x + nx) / 2, 6) as split, "left" from b where gap >= 0.12 and "left" >= 3 and lines - "left" >= 3""",
    "number_candidates": f"""with {EL}, t as (select trim(text, ' ') as token from el where length(text) <= 6 union select target from (select unnest(choices).target as target from enriched_portions) where length(target) <= 6),
        o as (select token, list_transform(list_filter(string_split(token, ''), lambda c: not regexp_full_match(c, '\\s*')), lambda c: {_CASE}) as o from t),
        f as (select * from o where len(o) > 0 and len(list_filter(o, lambda w: w is null)) = 0 and list_product(list_transform(o, lambda w: len(w))) <= 32),
        p as (select token, list_reduce(list_prepend([''], o), lambda a, w: flatten(list_transform(a, lambda x: list_transform(w, lambda y: x || y)))) as p from f),
        n as (select token, list_sort(list_distinct(list_transform(list_filter(p, lambda x: regexp_full_match(x, '[1-9][0-9]{{0,2}}')), lambda x: cast(x as int)))) as n from p)
      select token, array_to_string(n, ',') as numbers from n where len(n) > 0""",
    "scan_error_numbers": f"""with {EL}, c as (select element_key, text, [{_CUTS}] as c from el where length(text) <= 24), i as (select element_key, text, unnest(c) as x, generate_subscripts(c, 1) as i from c),
        u as (select element_key, x, min(i) as i from i where x is not null and x <> text group by 1, 2) select element_key, string_agg(x, '|' order by i) as candidates from u group by 1""",
    "rescue_lines": f"""with l as (select doc_id, trim(unnest(string_split(text, chr(10))), ' ') as t from documents) select doc_id, count(*) as lines from l
      where length(t) between 1 and 6 and {count('t', '[0-9]')} >= 1 and {count('t', '\\p{L}')} <= 2 group by 1""",
    "repaired_phrases": """with d as (select doc_id, string_split(regexp_replace(text, '\\b([Tt])urn to ([0-9]*[13579])\\b', '\\1um t0 \\2', 'g'), chr(10)) as l from documents), l as (select doc_id, unnest(l) as line, generate_subscripts(l, 1) - 1 as place from d),
        m as (select *, regexp_extract(line, '(?i)^(.*?)\\b(turn|tum)\\b\\s+\\b(to|t0)\\b\\s+([0-9]{1,4})\\b', ['a', 'v', 't', 'n']) as p, regexp_extract(line, '(?i)^(.*?)\\b(turn|tum)\\b\\s+\\b(to|t0)\\b\\s+([0-9]{1,4})\\b') as whole from l),
        f as (select doc_id, place, line, p.a || case when p.v = upper(p.v) then 'TURN' when regexp_matches(p.v, '^[A-Z]') then 'Turn' else 'turn' end || ' ' || case when p.t = upper(p.t) and regexp_matches(p.t, '[A-Z]') then 'TO' else 'to' end || ' ' || p.n || substr(line, length(whole) + 1) as fixed
          from m where p.v <> '' and (lower(p.v) = 'tum' or contains(p.t, '0') or (contains(p.t, 'O') and p.t <> upper(p.t))))
      select doc_id, cast(place as int) as place, md5(fixed) as digest from f where fixed <> line""",
    "key_value_lines": f"""with {EL}, l as (select element_key, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) - 1 as place from el), u as (select *, trim(line, ' ') as t, upper(trim(line, ' ')) as u from l),
        s as (select *, list_filter([{{'k': 'SKILL', 'v': regexp_extract(u, '\\bSKILL\\s+([0-9]{{1,3}})\\b', 1)}}, {{'k': 'STAMINA', 'v': regexp_extract(u, '\\bSTAMINA\\s+([0-9]{{1,3}})\\b', 1)}}, {{'k': 'LUCK', 'v': regexp_extract(u, '\\bLUCK\\s+([0-9]{{1,3}})\\b', 1)}}], lambda x: x.v <> '') as p,
          regexp_extract(t, '^([A-Za-z][A-Za-z ]{{1,24}}?)\\s*[:=]\\s*([0-9]{{0,4}})$', 1) as fk, regexp_extract(t, '^([A-Za-z][A-Za-z ]{{1,24}}?)\\s*[:=]\\s*([0-9]{{0,4}})$', 2) as fv from u)
      select element_key, cast(place as int) as place, nullif(regexp_replace(trim(regexp_extract(u, '\\b([A-Z][A-Z'' -]{{2,30}})\\s+SKILL\\s+[0-9]{{1,3}}\\b', 1), ' '), ' +', ' ', 'g'), '') as entity, len(p) as pairs, p[1].k as key, cast(p[1].v as int) as value
        from s where contains(u, 'SKILL') and contains(u, 'STAMINA') and len(p) > 0
      union all select element_key, cast(place as int), null, 1, upper(regexp_replace(trim(fk, ' '), ' +', ' ', 'g')), try_cast(nullif(fv, '') as int) from s where fk <> '' and not (contains(u, 'SKILL') and contains(u, 'STAMINA') and len(p) > 0)""",
    "form_pages": f"""with {EL}, {_LINES}, f as (select run_id, page, {_FILLED} as x from pl), g as (select run_id, page, x, len(x) as n, upper(array_to_string(x, ' ')) as t from f where len(x) > 0),
        s as (select run_id, page, round(least(1.0, case when list_sum(list_transform(x, lambda s: length(s))) / n < 8 then 0.4 when list_sum(list_transform(x, lambda s: length(s))) / n < 12 then 0.2 else 0.0 end
          + case when len(list_filter(x, lambda s: contains(s, '='))) / n > 0.3 then 0.3 else 0.0 end + case when len(list_filter(x, lambda s: s = upper(s) and s <> lower(s) and length(s) < 20)) / n > 0.2 then 0.2 else 0.0 end
          + case when {' + '.join(f"contains(t, '{w}')::int" for w in _FORM)} >= 3 then 0.3 when {' + '.join(f"contains(t, '{w}')::int" for w in _FORM)} >= 1 then 0.1 else 0.0 end
          + case when len(list_filter(x, lambda s: length(s) < 5 and not regexp_full_match(s, '[0-9]+'))) / n > 0.4 then 0.2 else 0.0 end), 3) as confidence from g)
      select run_id, page, cast(confidence as double) as confidence, confidence >= 0.5 as is_form from s where confidence > 0""",
    "page_fragments": f"""with l as (select doc_id, string_split(text, chr(10)) as l from documents where text is not null), f as (select doc_id, list_transform(l, lambda x: {_FRAGMENT.format(x='x', w=_SHORT)}) as f from l),
        c as (select doc_id, len(f) as n, len(list_filter(f, lambda x: x)) as fragments, coalesce(list_position(list_reverse(f), false), 0) as p from f), t as (select *, case when p > 0 then p - 1 else n end as tail from c)
      select doc_id, fragments, cast(case when n >= 5 and tail >= 3 and tail >= 0.5 * fragments then tail else 0 end as int) as trailing from t where fragments > 0""",
    "engine_quality": f"with {EL}, {_READ} select run_id, page, engine, words, dictionary, confusion, case when words >= 10 then round(1 - greatest(dictionary, confusion), 4) end as quality from sp",
    "best_engines": f"""with {EL}, {_READ}, s as (select run_id, page, engine, preference, {_FILLED} as x, lines, dictionary, confusion from sp where length(trim(array_to_string(lines, ''), ' ')) >= 40),
        c as (select *, round(least(1.5, 0.55 * dictionary + 0.25 * confusion + 0.35 * case when len(x) = 0 then 0 else 1 - len(list_distinct(x)) / len(x) end + case when length(trim(array_to_string(lines, chr(10)), ' ')) < 40 then 0.25 else 0 end), 4) as score from s)
      select run_id, page, engine, score from c qualify row_number() over (partition by run_id, page order by score, preference) = 1""",
    "content_retention": f"""with p as (select distinct page_key, {STRIP.format(c='html')} as a, {STRIP.format(c="regexp_replace(html, '<table.*</table>', '', 'g')")} as b from pages_html where html is not null),
        t as (select page_key, a, b, list_filter(regexp_split_to_array(lower(a), '[^a-z0-9]+'), lambda x: length(x) > 1) as x, list_filter(regexp_split_to_array(lower(b), '[^a-z0-9]+'), lambda x: length(x) > 1) as y from p),
        r as (select page_key, case when len(x) = 0 then 1.0 else round(len(list_filter(x, lambda w: list_contains(y, w))) / len(x), 4) end as recall, case when length(a) = 0 then 1.0 else round(length(b) / length(a), 4) end as ratio, length(a) as chars from t)
      select *, recall >= 0.9 and (chars < 120 or ratio >= 0.8) as retained from r where ratio < 1""",
    "figure_scores": f"""with p as (select distinct page_key, {count('html', '<figure[ >]')} as figures, {count('html', '<img[^>]* src=')} as sourced, {count('html', '<img[ >]')} as images, {count('html', '<figcaption[ >]')} as captions, {count('html', 'data-placement="')} as placed from pages_html)
      select *, images - sourced as unsourced from p where figures + images + captions > 0""",
    "reading_metadata": """with h as (select distinct page_key, regexp_extract(html, '(?i)<meta[^>]*name\\s*=\\s*["'']ocr-metadata["''][^>]*>') as h from pages_html)
      select page_key, """ + ", ".join(f"""greatest(0.0, least(1.0, try_cast(nullif(regexp_extract(h, '(?i){k}\\s*=\\s*["'']([^"'']+)["'']', 1), '') as double))) as {a}""" for k, a in (("data-ocr-quality", "quality"), ("data-ocr-integrity", "integrity"), ("data-continuation-risk", "risk"))) + " from h",
    "images_by_page": """with e as (select vec_id, label, cast(floor(abs(embedding[2]) * 100) as int) as t, cast(floor(abs(embedding[1]) * 100) as int) as l from embeddings) select label, vec_id, row_number() over (partition by label order by t, l, vec_id) as place from e""",
    "capability_gaps": f"""with {EL} select lower(content_type) as capability, count(distinct page) as pages, min(page) as first_page, 'missing' as severity from el where content_type is not null and lower(content_type) not in (select label from text_labels) group by 1""",
    "verdict_scores": """with t as (select distinct src_table, rec_key, annotator, label from text_labels), v as (select src_table, rec_key, label, count(*) as n from t group by 1, 2, 3), g as (select src_table, rec_key, arg_min(label, (-n, label)) as golden from v group by 1, 2),
        j as (select annotator, label = 'junk' as s, golden = 'junk' as k from t join g using (src_table, rec_key)), c as (select annotator, sum((s and k)::int) as tp, sum((not s and not k)::int) as tn, sum((s and not k)::int) as fp, sum((not s and k)::int) as fn from j group by 1)
      select *, round((tp + tn) / (tp + tn + fp + fn), 4) as score from c""",
    "node_errors": f"""with g as (select section_key, run_id, {section('section_id')} as node, end_game, sequence from (select distinct section_key, run_id, section_id, end_game, sequence from gamebook_sections where deleted_at is null)),
        t as (select distinct section_key, run_id, {section('t')} as node from (select section_key, run_id, e.kind as kind, e.targetSection as t from (select section_key, run_id, unnest(sequence) as e from g)) where kind = 'choice' and {section('t')} is not null)
      select section_key, 'target not found: ' || node as error from t where not exists (select 1 from g where g.run_id = t.run_id and g.node = t.node)
      union all select section_key, 'ending with choices' from g where end_game and section_key in (select section_key from t)
      union all select section_key, 'no choices' from g where not end_game and section_key not in (select section_key from t)
      union all select section_key, 'duplicate id' from g where exists (select 1 from g h where h.run_id = g.run_id and h.node = g.node and h.section_key < g.section_key)""",
    "expected_ranges": f"""with {P}, n as (select run_id, max(try_cast({section('section_id')} as int)) as n from p group by 1) select run_id, 1 as low, n as high from n""",
    "portion_page_text": f"""with {P}, {_LATEST}, t as (select run_id, page, length({STRIP.format(c='html')}) as chars from lp)
      select portion_key, count(chars) as pages, coalesce(sum(chars), 0) as chars from (select portion_key, run_id, unnest(range(page_start, page_end + 1)) as page from p) s left join t on t.run_id = s.run_id and t.page = s.page group by 1""",
}
