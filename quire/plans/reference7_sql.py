"""SQL twins of the seventh set of document queries."""

from __future__ import annotations

from quire.plans.reference_sql import P

_BOX = "b as (select vec_id, label, abs(cast(embedding[1] as double)) as x, abs(cast(embedding[2] as double)) as y, abs(cast(embedding[3] as double)) as w, abs(cast(embedding[4] as double)) as h from embeddings)"

SQL: dict[str, str] = {
    "json_lines_round_trip": "select distinct raw_key, run_id, record from raw_portions",
    "image_order": """with p as (select distinct run_id, image from pages_html where image is not null)
      select run_id, image, row_number() over (partition by run_id order by list_transform(regexp_extract_all(image, '[0-9]+'), lambda x: cast(x as bigint)), image) as place from p""",
    "element_batches": """with e as (select distinct element_key, run_id, seq from elements_core_content_types_rubric_v1), b as (select *, cast((row_number() over (partition by run_id order by seq, element_key) - 1) // 25 as int) as batch from e)
      select run_id, batch, count(*) as elements, min(seq) as first, max(seq) as last from b group by 1, 2""",
    "latest_reports": "select distinct run_id, report_key, module_id, schema_version from pipeline_issues qualify row_number() over (partition by run_id order by report_key desc) = 1",
    "conformed_portions": f"with {P} select portion_key, section_id, cast(page_start as bigint) as page_start, confidence, cast(null as varchar) as title from p where confidence >= 0.5 and page_start > 0",
    "stamped_portions": "select distinct portion_key, coalesce(schema_version, 'enriched_portion_v1') as schema_version, coalesce(module_id, 'portionize_v1') as module_id, coalesce(run_id, 'run-unknown') as run_id from enriched_portions",
    "plan_run": "select r_regionkey as region, r_name as name, n from region left join (select n_regionkey, count(*) as n from nation where n_nationkey >= 5 group by 1) c on c.n_regionkey = r_regionkey",
    "stub_portions": "select distinct run_id, 'P' || lpad(cast(page as varchar), 3, '0') as portion_id, page as page_start, page as page_end, 'page' as type, 1.0 as confidence from pages_html where html is not null",
    "run_snapshots": """with p as (select run_id, module_id, max(schema_version) as v from enriched_portions where module_id is not null group by 1, 2)
      select run_id, '{' || string_agg('"' || module_id || '":"' || v || '"', ',' order by module_id) || '}' as snapshot from p group by 1""",
    "box_sizes": f"with {_BOX}, p as (select label, max(x + w) as pw, max(y + h) as ph from b group by 1), s as (select vec_id, round(w * h / (pw * ph), 6) as share from b join p using (label)) select *, share >= 0.95 as full_page from s",
}
