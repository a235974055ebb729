"""Registered queries over processed postings (the transform's output built from the driver
tables): the search page as the reference's UI sends it (G5 with every filter kind), its
total, the three facet lists in one scan (G6), facet counts given the other selections (E1)
and the detail projection (P22)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import facets as FC
from ..operators import predicates as P
from ..operators import search as S
from ..operators.export import detail_view
from .queries_transform import postings_cte_sql, postings_frame
from .registry import register

SEARCH = P.SearchSpec.postings(
    search="Customer#0000001",
    agencies=["BUILDING", "AUTOMOBILE", "MACHINERY"],
    categories=["Health", "Legal Affairs", "Green Jobs"],
    full_time=["full_time", "part_time"],
    exam=["no_exam"],
    posting_types=["External"],
    salary_min=50000,
    salary_max=400000,
    posted_preset="custom",
    posted_from="1996-01-01",
    posted_to="2000-12-31",
    order_by="salary_range_from",
    descending=True,
    limit=25,
    offset=0,
)

_WHERE = """
    (contains(lower(business_title), 'customer#0000001') OR contains(lower(agency), 'customer#0000001')
     OR contains(lower(job_description), 'customer#0000001'))
    AND agency IN ('BUILDING', 'AUTOMOBILE', 'MACHINERY')
    AND list_has_any(job_categories, ['Health', 'Legal Affairs', 'Green Jobs'])
    AND requires_exam = false
    AND posting_type = 'External'
    AND salary_range_to >= 50000 AND salary_range_from <= 400000
    AND posted_date >= DATE '1996-01-01' AND posted_date <= DATE '2000-12-31'
"""

_PAGE_COLS = ("id", "job_id", "agency", "salary_range_from", "salary_range_to", "posted_date")


@register(
    "postings_search_page",
    postings_cte_sql()
    + f"""
    SELECT id, job_id, agency, salary_range_from, salary_range_to, posted_date,
           array_to_string(job_categories, '|') AS categories
    FROM postings WHERE {_WHERE}
    ORDER BY salary_range_from DESC NULLS LAST, id ASC NULLS LAST
    LIMIT 25
    """,
)
def postings_search_page(spark, sf_dir):
    res = S.search(postings_frame(spark, sf_dir), SEARCH)
    return res.page.select(*_PAGE_COLS, F.array_join("job_categories", "|").alias("categories"))


@register("postings_search_total", postings_cte_sql() + f"SELECT count(*) AS total FROM postings WHERE {_WHERE}")
def postings_search_total(spark, sf_dir):
    return S.search(postings_frame(spark, sf_dir), SEARCH).total


@register(
    "postings_facets",
    postings_cte_sql()
    + """
    SELECT DISTINCT facet, value FROM (
      SELECT 'agency' AS facet, agency AS value FROM postings
      UNION ALL SELECT 'civil_service_title', civil_service_title FROM postings
      UNION ALL SELECT 'job_categories', unnest(job_categories) FROM postings
    ) WHERE value IS NOT NULL AND value <> ''
    """,
)
def postings_facets(spark, sf_dir):
    return FC.facets(postings_frame(spark, sf_dir), scalar=["agency", "civil_service_title"], arrays=["job_categories"])


COUNTS = P.SearchSpec.postings(agencies=["BUILDING"], categories=["Health"], posting_types=["External"])


@register(
    "postings_facet_counts",
    postings_cte_sql()
    + """
    SELECT 'agency' AS facet, agency AS value, count(*) AS n FROM postings
    WHERE list_has_any(job_categories, ['Health']) AND posting_type = 'External' AND agency IS NOT NULL AND agency <> ''
    GROUP BY 1, 2
    UNION ALL
    SELECT 'job_categories', v, count(*) FROM (
      SELECT unnest(list_distinct(job_categories)) AS v FROM postings
      WHERE agency IN ('BUILDING') AND posting_type = 'External')
    WHERE v IS NOT NULL AND v <> '' GROUP BY 1, 2
    UNION ALL
    SELECT 'civil_service_title', civil_service_title, count(*) FROM postings
    WHERE agency IN ('BUILDING') AND list_has_any(job_categories, ['Health']) AND posting_type = 'External'
      AND civil_service_title IS NOT NULL AND civil_service_title <> ''
    GROUP BY 1, 2
    """,
)
def postings_facet_counts(spark, sf_dir):
    return FC.facet_counts(
        postings_frame(spark, sf_dir), COUNTS, scalar=["agency", "civil_service_title"], arrays=["job_categories"]
    )


def _dollars_sql(x: str) -> str:
    return f"(CASE WHEN {x} < 0 THEN '-' ELSE '' END || '$' || format('{{:,}}', CAST(round(abs({x})) AS BIGINT)))"


_LINK_SQL = """
    'https://example.org/jobs?q=' || replace(replace(replace(replace(replace(replace(
        url_encode(regexp_replace(concat_ws(' ', business_title, agency), '\\s+', '_', 'g')),
        '%21', '!'), '%7E', '~'), '%2A', '*'), '%27', ''''), '%28', '('), '%29', ')')
"""


@register(
    "postings_detail",
    postings_cte_sql()
    + f"""
    SELECT id,
      CASE WHEN is_full_time THEN 'Full-time' ELSE 'Part-time' END AS schedule,
      CASE WHEN salary_range_from IS NULL OR salary_range_from = 0 THEN 'Not specified'
           WHEN salary_range_to IS NOT NULL AND salary_range_to <> 0 AND salary_range_to <> salary_range_from
             THEN {_dollars_sql('salary_range_from')} || ' - ' || {_dollars_sql('salary_range_to')}
                  || ' (' || coalesce(nullif(salary_frequency, ''), 'Annual') || ')'
           ELSE {_dollars_sql('salary_range_from')} || ' (' || coalesce(nullif(salary_frequency, ''), 'Annual') || ')'
      END AS salary,
      coalesce(nullif(title_classification, ''), '—') || CASE WHEN requires_exam THEN ' (Exam Required)' ELSE '' END
        AS title_classification,
      coalesce(nullif(number_of_positions, ''), '—') AS number_of_positions,
      coalesce(strftime(posted_date, '%A, %B %-d, %Y'), '—') AS posted,
      coalesce(strftime(posted_until_date, '%A, %B %-d, %Y'), '—') AS post_until,
      coalesce(business_title, '') AS business_title, coalesce(agency, '') AS agency, nullif(work_location, '') AS work_location,
      array_to_string(job_categories, '|') AS job_categories, coalesce(nullif(civil_service_title, ''), '—') AS civil_service_title,
      coalesce(nullif(career_level, ''), '—') AS career_level, nullif(division_work_unit, '') AS division_work_unit,
      nullif(residency_requirement, '') AS residency_requirement,
      CASE WHEN nullif(job_description, '') IS NOT NULL THEN '<p>' || job_description || '</p>' END AS description_html,
      CASE WHEN nullif(minimum_qual_requirements, '') IS NOT NULL THEN '<p>' || minimum_qual_requirements || '</p>' END AS qualifications_html,
      strftime(posting_updated_date, '%A, %B %-d, %Y') AS last_updated,
      CASE WHEN coalesce(posting_type, '') <> 'Internal' THEN {_LINK_SQL} END AS apply_link,
      coalesce(posting_type, '') = 'Internal' AS internal_only
    FROM postings
    """,
)
def postings_detail(spark, sf_dir):
    d = detail_view(postings_frame(spark, sf_dir))  # these texts have no sections or lists
    return d.withColumn("job_categories", F.array_join("job_categories", "|"))
