"""Registered query: the snapshot transform (G1) end to end on raw-shaped text.

Orders joined to their customers are rendered as raw snapshot records (every field a
string, dates as the source prints them) and run through ``transform_postings`` -- strict
casts, day-month-year parsing, flags, the 14-category splitter and the row hash. The
DuckDB oracle builds the same raw text and applies the same rules in SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.predicates import CAREER_LEVELS
from ..schema import JOB_CATEGORIES, RAW_FIELDS
from ..session import table
from .registry import register
from .transform import transform_postings

FREQUENCIES = ("Annual", "Hourly", "Daily")


def _sql_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


_RAW_SQL = f"""
    raw AS (
      SELECT
        CAST(o.o_orderkey AS VARCHAR) AS job_id,
        c.c_mktsegment AS agency,
        CASE WHEN o.o_orderstatus = 'O' THEN 'Internal' ELSE 'External' END AS posting_type,
        CAST(o.o_custkey % 5 + 1 AS VARCHAR) AS number_of_positions,
        c.c_name AS business_title,
        'TITLE ' || CAST(c.c_nationkey AS VARCHAR) AS civil_service_title,
        CASE WHEN o.o_orderpriority = '1-URGENT' THEN 'Competitive-1' ELSE 'Non-Competitive' END AS title_classification,
        CAST(o.o_custkey AS VARCHAR) AS title_code_no,
        substr(o.o_orderpriority, 1, 1) AS level,
        {_sql_list(JOB_CATEGORIES)}[o.o_orderkey % 14 + 1] || ' ' || {_sql_list(JOB_CATEGORIES)}[o.o_custkey % 14 + 1] AS job_category,
        CASE WHEN o.o_orderstatus = 'F' THEN 'F' WHEN o.o_orderstatus = 'O' THEN 'P' END AS full_time_part_time_indicator,
        {_sql_list(CAREER_LEVELS)}[o.o_custkey % 4 + 1] AS career_level,
        CAST(CAST(o.o_totalprice AS DECIMAL(18, 2)) AS VARCHAR) AS salary_range_from,
        CASE WHEN o.o_orderpriority = '5-LOW' THEN NULL
             ELSE CAST(CAST(o.o_totalprice * 2 AS DECIMAL(18, 2)) AS VARCHAR) END AS salary_range_to,
        {_sql_list(FREQUENCIES)}[o.o_orderkey % 3 + 1] AS salary_frequency,
        'Floor ' || CAST(c.c_nationkey AS VARCHAR) AS work_location,
        'Unit ' || o.o_orderstatus AS division_work_unit,
        'Order ' || CAST(o.o_orderkey AS VARCHAR) || ' for ' || c.c_name AS job_description,
        CASE WHEN o.o_orderstatus = 'P' THEN NULL ELSE 'Degree' END AS minimum_qual_requirements,
        'Required' AS residency_requirement,
        strftime(o.o_orderdate, '%Y-%m-%dT%H:%M:%S.000') AS posting_date,
        upper(strftime(o.o_orderdate + INTERVAL 30 DAY, '%d-%b-%Y')) AS post_until,
        strftime(o.o_orderdate, '%Y-%m-%dT%H:%M:%S.000') AS posting_updated,
        CAST(year(o.o_orderdate) AS VARCHAR) || '-01-01T00:00:00.000' AS process_date
      FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)
"""

_DOUBLE_COLS = ("salary_range_from", "salary_range_to")
_DATE_COLS = ("posted_date", "posted_until_date", "posting_updated_date", "processed_date")


_BODY = [
    "job_id", "agency", "posting_type", "number_of_positions", "business_title", "civil_service_title",
    "title_classification", "title_code_no", "level", "job_category", "career_level", "salary_range_from",
    "salary_range_to", "full_time_part_time_indicator", "salary_frequency", "work_location",
    "division_work_unit", "job_description", "minimum_qual_requirements", "residency_requirement",
    "posted_date", "posted_until_date", "posting_updated_date", "processed_date", "requires_exam",
    "is_full_time", "job_categories",
]


def _text_sql(c: str) -> str:
    if c == "job_categories":
        return f"array_to_string({c}, chr(30))"
    if c in _DOUBLE_COLS + _DATE_COLS + ("requires_exam", "is_full_time"):
        return f"CAST({c} AS VARCHAR)"
    return c


ID_SQL = (
    "md5(concat_ws(chr(31), "
    + ", ".join(f"coalesce({_text_sql(c)}, chr(1))" for c in _BODY)
    + "))"
)


def _categories_sql(mode: str) -> str:
    if mode == "chained":
        marked = "job_category"
        for c in JOB_CATEGORIES:
            marked = f"replace({marked}, '{c}', '|{c}')"
        return f"list_transform(list_filter(string_split({marked}, '|'), lambda x: length(x) > 0), lambda x: trim(x))"
    longest_first = "|".join(sorted(JOB_CATEGORIES, key=len, reverse=True))
    marked = f"regexp_replace(job_category, '({longest_first})', '|\\1', 'g')"
    return f"list_filter(list_transform(string_split({marked}, '|'), lambda x: trim(x)), lambda x: length(x) > 0)"


def postings_cte_sql(mode: str = "longest") -> str:
    """``WITH raw AS (...), typed AS (...), added AS (...), postings AS (...)``: the oracle
    side of the transform, written by hand; ``postings`` holds the 28 processed columns."""
    return (
        "WITH "
        + _RAW_SQL
        + f""",
    typed AS (
      SELECT job_id, agency, posting_type, number_of_positions, business_title, civil_service_title,
             title_classification, title_code_no, level, job_category, career_level,
             CAST(salary_range_from AS DOUBLE) AS salary_range_from,
             CAST(salary_range_to AS DOUBLE) AS salary_range_to,
             full_time_part_time_indicator, salary_frequency, work_location, division_work_unit,
             job_description, minimum_qual_requirements, residency_requirement,
             CAST(posting_date AS DATE) AS posted_date,
             CAST(strptime(post_until, '%d-%b-%Y') AS DATE) AS posted_until_date,
             CAST(posting_updated AS DATE) AS posting_updated_date,
             CAST(process_date AS DATE) AS processed_date
      FROM raw),
    added AS (
      SELECT *, title_classification = 'Competitive-1' AS requires_exam,
             full_time_part_time_indicator = 'F' AS is_full_time,
             {_categories_sql(mode)} AS job_categories
      FROM typed),
    postings AS (SELECT {ID_SQL} AS id, * FROM added)
    """
    )


_SCALARS = ["id", *_BODY[:-1]]


def _oracle_sql(mode: str = "longest") -> str:
    shown = ", ".join(_SCALARS)
    return postings_cte_sql(mode) + f"SELECT {shown}, array_to_string(job_categories, '|') AS categories, len(job_categories) AS n_categories FROM postings"


def raw_frame(spark, sf_dir):
    o = table(spark, sf_dir, "orders").alias("o")
    c = table(spark, sf_dir, "customer").alias("c")
    j = o.join(c, F.col("o.o_custkey") == F.col("c.c_custkey"))
    cats = F.array(*[F.lit(x) for x in JOB_CATEGORIES])
    levels = F.array(*[F.lit(x) for x in CAREER_LEVELS])
    freqs = F.array(*[F.lit(x) for x in FREQUENCIES])
    okey, ckey, status, prio = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus"), F.col("o_orderpriority")
    iso = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS")
    cols = {
        "job_id": okey.cast("string"),
        "agency": F.col("c_mktsegment"),
        "posting_type": F.when(status == "O", F.lit("Internal")).otherwise(F.lit("External")),
        "number_of_positions": (ckey % 5 + 1).cast("string"),
        "business_title": F.col("c_name"),
        "civil_service_title": F.concat(F.lit("TITLE "), F.col("c_nationkey").cast("string")),
        "title_classification": F.when(prio == "1-URGENT", F.lit("Competitive-1")).otherwise(F.lit("Non-Competitive")),
        "title_code_no": ckey.cast("string"),
        "level": F.substring(prio, 1, 1),
        "job_category": F.concat(F.element_at(cats, (okey % 14 + 1).cast("int")), F.lit(" "), F.element_at(cats, (ckey % 14 + 1).cast("int"))),
        "full_time_part_time_indicator": F.when(status == "F", F.lit("F")).when(status == "O", F.lit("P")),
        "career_level": F.element_at(levels, (ckey % 4 + 1).cast("int")),
        "salary_range_from": F.col("o_totalprice").cast("decimal(18,2)").cast("string"),
        "salary_range_to": F.when(prio == "5-LOW", F.lit(None).cast("string")).otherwise(
            (F.col("o_totalprice") * 2).cast("decimal(18,2)").cast("string")
        ),
        "salary_frequency": F.element_at(freqs, (okey % 3 + 1).cast("int")),
        "work_location": F.concat(F.lit("Floor "), F.col("c_nationkey").cast("string")),
        "division_work_unit": F.concat(F.lit("Unit "), status),
        "job_description": F.concat(F.lit("Order "), okey.cast("string"), F.lit(" for "), F.col("c_name")),
        "minimum_qual_requirements": F.when(status == "P", F.lit(None).cast("string")).otherwise(F.lit("Degree")),
        "residency_requirement": F.lit("Required"),
        "posting_date": iso,
        "post_until": F.upper(F.date_format(F.date_add(F.col("o_orderdate").cast("date"), 30), "dd-MMM-yyyy")),
        "posting_updated": iso,
        "process_date": F.concat(F.year("o_orderdate").cast("string"), F.lit("-01-01T00:00:00.000")),
    }
    return j.select(*[cols[f].alias(f) for f in RAW_FIELDS])


def postings_frame(spark, sf_dir):
    """Processed postings built from the driver tables (the transform's output)."""
    return transform_postings(raw_frame(spark, sf_dir))


def _all_columns(postings):
    return postings.select(*_SCALARS, F.array_join("job_categories", "|").alias("categories"), F.size("job_categories").alias("n_categories"))


@register("transform_snapshot", _oracle_sql())
def transform_snapshot(spark, sf_dir):
    return _all_columns(postings_frame(spark, sf_dir))


@register("transform_snapshot_chained", _oracle_sql("chained"))
def transform_snapshot_chained(spark, sf_dir):
    """The splitter as chained replaces, which is what the reference's data shows."""
    return _all_columns(transform_postings(raw_frame(spark, sf_dir), phrase_mode="chained"))
