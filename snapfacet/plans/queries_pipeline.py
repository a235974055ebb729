"""Registered queries: the snapshot pipeline end to end (S1, S4-S9, S12, G2-G4, G5 over S9).

Raw postings rendered from the orders (see ``queries_transform``) are landed under their snapshot
keys in a new folder below the shared checkpoint folder, processed, and read back.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import predicates as P
from ..operators import search as S
from ..session import scratch
from ..sources import snapshots as SRC
from ..sources import versions as V
from . import pipeline as PL
from . import quality as Q
from .queries_postings import _PAGE_COLS
from .queries_transform import postings_cte_sql, raw_frame
from .registry import register
from .transform import transform_postings

_KEY_SQL = "replace(split_part(process_date, '.', 1), ':', '-')"
_COLS = "id, job_id, agency, salary_range_from, salary_range_to, posted_date, processed_date"


def _landed(spark, sf_dir):
    root = scratch(spark, "postings")
    SRC.write_raw(raw_frame(spark, sf_dir), root)
    return root


def _processed(spark, sf_dir, late=False):
    """A processed root; with ``late`` the first snapshot comes in a second run, after the others."""
    root = scratch(spark, "postings")
    raw = SRC.with_snapshot_partition(raw_frame(spark, sf_dir))
    if late:
        first = raw.agg(F.min(SRC.SNAPSHOT)).first()[0]
        SRC.write_raw(raw.where(F.col(SRC.SNAPSHOT) != F.lit(first)), root)
        PL.run_latest(spark, root, fetched_at=dt.datetime(2024, 1, 1))
        SRC.write_raw(raw.where(F.col(SRC.SNAPSHOT) == F.lit(first)), root)
    else:
        SRC.write_raw(raw, root)
    PL.run_latest(spark, root, fetched_at=dt.datetime(2024, 1, 1))
    return root


@register(
    "pipeline_load_latest",
    postings_cte_sql() + f"SELECT {_COLS} FROM postings WHERE processed_date = (SELECT max(processed_date) FROM postings)",
)
def pipeline_load_latest(spark, sf_dir):
    """S9 after G2: the newest snapshot, also when an older one was processed last."""
    return SRC.load_latest(spark, _processed(spark, sf_dir, late=True)).select(*_COLS.split(", "))


@register(
    "pipeline_state",
    postings_cte_sql()
    + """
    SELECT strftime(max(processed_date), '%Y-%m-%dT00-00-00') AS snapshot, TIMESTAMP '2024-01-01' AS last_fetched_at,
      count(*) FILTER (processed_date = (SELECT max(processed_date) FROM postings)) AS record_count FROM postings
    """,
)
def pipeline_state(spark, sf_dir):
    """S8 after a late snapshot and a reprocess: newest snapshot, last fetch kept."""
    root = _processed(spark, sf_dir, late=True)
    PL.reprocess_all(spark, root)
    return SRC.read_state(spark, root).select("snapshot", "last_fetched_at", "record_count")


@register(
    "pipeline_history",
    postings_cte_sql() + "SELECT strftime(processed_date, '%Y-%m-%dT00-00-00') AS snapshot, id, job_id, agency FROM postings",
)
def pipeline_history(spark, sf_dir):
    """G3 + G4: all snapshots reprocessed, the history rebuilt (no long texts) and read back."""
    root = _landed(spark, sf_dir)
    PL.reprocess_all(spark, root)
    return PL.rebuild_history(spark, root).select("snapshot", "id", "job_id", "agency")


@register(
    "state_after_crash",
    postings_cte_sql()
    + """
    SELECT strftime(max(processed_date), '%Y-%m-%dT00-00-00') AS snapshot,
      count(*) FILTER (processed_date = (SELECT max(processed_date) FROM postings)) AS record_count FROM postings
    """,
)
def state_after_crash(spark, sf_dir):
    """A writer died in the middle of its state file; the state before it is read."""
    root = _processed(spark, sf_dir)
    half = spark.createDataFrame([('{"snapshot": "2999-01-01", "record_co',)], "value string")
    half.coalesce(1).write.text(f"{root}/state/version=99990101T000000.000000-dead")
    return SRC.read_state(spark, root).select("snapshot", "record_count")


@register(
    "history_after_crash",
    postings_cte_sql() + "SELECT strftime(processed_date, '%Y-%m-%dT00-00-00') AS snapshot, count(*) AS records FROM postings GROUP BY 1",
)
def history_after_crash(spark, sf_dir):
    """A rebuild died after writing part of its rows; the history before it is read, whole."""
    root = _processed(spark, sf_dir)
    history = SRC.read_history(spark, root)
    V.write(spark, f"{root}/history", history.where(F.col(SRC.SNAPSHOT) < F.lit("1996")), SRC.SNAPSHOT)
    return SRC.read_history(spark, root).groupBy(SRC.SNAPSHOT).agg(F.count(F.lit(1)).alias("records"))


@register(
    "quarantine_counts",
    postings_cte_sql()
    + """
    , bad AS (SELECT *, CASE WHEN posting_type = 'Internal' AND agency = 'BUILDING' THEN 'salary_range_from' END AS a,
              CASE WHEN level = '4' THEN 'post_until' END AS b FROM raw),
    r AS (SELECT strftime(CAST(split_part(process_date, '.', 1) AS TIMESTAMP), '%Y-%m-%dT%H-%M-%S') AS snapshot, concat_ws('+', a, b) AS reasons FROM bad)
    SELECT snapshot, CASE WHEN reasons = '' THEN 'processed' ELSE reasons END AS outcome, count(*) AS records FROM r GROUP BY 1, 2
    """,
)
def quarantine_counts(spark, sf_dir):
    """Two kinds of bad records among all landed ones: processed and set aside, per snapshot and reason."""
    root = scratch(spark, "postings")
    raw = raw_frame(spark, sf_dir)
    price = F.when((F.col("posting_type") == "Internal") & (F.col("agency") == "BUILDING"), F.lit("n/a")).otherwise(F.col("salary_range_from"))
    until = F.when(F.col("level") == "4", F.lit("soon")).otherwise(F.col("post_until"))
    SRC.write_raw(raw.withColumn("salary_range_from", price).withColumn("post_until", until), root)
    PL.run_latest(spark, root, fetched_at=dt.datetime(2024, 1, 1), quarantine=True)
    good = SRC.read_processed(spark, root).select(SRC.SNAPSHOT, F.lit("processed").alias("outcome"))
    bad = Q.read_quarantine(spark, root).select(SRC.SNAPSHOT, F.array_join("reasons", "+").alias("outcome"))
    return good.union(bad).groupBy(SRC.SNAPSHOT, "outcome").agg(F.count(F.lit(1)).alias("records"))


@register(
    "pipeline_snapshots",
    postings_cte_sql() + f"SELECT DISTINCT {_KEY_SQL} AS snapshot FROM raw",
)
def pipeline_snapshots(spark, sf_dir):
    """S4 + S12: the landed snapshot keys."""
    return SRC.list_snapshots(spark, f"{_landed(spark, sf_dir)}/raw")


@register(
    "landed_pages",
    postings_cte_sql()
    + """
    , p AS (SELECT CAST(job_id AS BIGINT) // 1000 AS page, count(*) AS records FROM raw GROUP BY 1)
    SELECT page, records, records = 1000 AS "full", page = (SELECT max(page) FROM p) AS "last",
      records = 1000 OR page = (SELECT max(page) FROM p) AS ok FROM p
    """,
)
def landed_pages(spark, sf_dir):
    """All records landed in pages of a thousand job numbers, and the report on the pages."""
    path = f"{scratch(spark, 'pages')}/landed"
    raw = raw_frame(spark, sf_dir).withColumn("page", F.floor(F.col("job_id").cast("long") / 1000))
    raw.repartition("page").write.partitionBy("page").json(path)
    _, report = SRC.read_landed_pages(spark, path, page_size=1000)
    return report.select("page", "records", "full", "last", "ok")


@register("landed_records", postings_cte_sql() + "SELECT job_id, agency, process_date, 1 AS copies FROM raw")
def landed_records(spark, sf_dir):
    """The records of pages that overlap (every page is landed twice), each with half of its copies."""
    path = f"{scratch(spark, 'pages')}/landed"
    raw = raw_frame(spark, sf_dir).withColumn("page", F.floor(F.col("job_id").cast("long") / 1000))
    # a page is a small file that one task reads: compressed, it is a fraction of its text
    raw.union(raw).repartition("page").write.partitionBy("page").option("compression", "snappy").json(path)
    records, _ = SRC.read_landed_pages(spark, path, page_size=2000)
    return SRC.duplicate_records(records).select("job_id", "agency", "process_date", (F.col("copies") / 2).cast("int").alias("copies"))


@register("snapshot_probe", postings_cte_sql() + "SELECT max(process_date) AS process_date, count(DISTINCT process_date) AS n_dates FROM raw")
def snapshot_probe(spark, sf_dir):
    """S3: the date of a pull, and whether it is one."""
    root = _landed(spark, sf_dir)
    return SRC.probe_snapshot_date(SRC.read_raw(spark, root))


# The words of the postings' titles and agencies, with their English stems; "for" is a stop word.
_STEMS_SQL = """
    (VALUES ('automobile', 'automobil'), ('building', 'build'), ('customer', 'custom'), ('furniture', 'furnitur'), ('household', 'household'),
            ('machinery', 'machineri'), ('order', 'order'), ('title', 'titl')) AS stems(word, stem)
"""


@register(
    "pipeline_index_latest",
    postings_cte_sql()
    + f"""
    , t AS (SELECT id, unnest(string_split_regex(lower(concat_ws(' ', business_title, job_description, agency, civil_service_title)), '[^a-z]+')) AS word
        FROM postings WHERE processed_date = (SELECT max(processed_date) FROM postings))
    SELECT stem AS term, count(DISTINCT id) AS df FROM t JOIN {_STEMS_SQL} USING (word) GROUP BY 1
    """,
)
def pipeline_index_latest(spark, sf_dir):
    """E2 with X3 and X4: the index that the pipeline stored beside the newest snapshot, with stop words and stems."""
    root = _landed(spark, sf_dir)
    PL.run_latest(spark, root, build_index=True, fetched_at=dt.datetime(2024, 1, 1))
    return PL.load_latest_index(spark, root).terms.select("term", "df")


@register(
    "search_unknown_sort",
    postings_cte_sql() + "SELECT id, posted_date FROM postings WHERE agency = 'BUILDING' ORDER BY posted_date DESC NULLS LAST, id LIMIT 25",
)
def search_unknown_sort(spark, sf_dir):
    """A sort key that is not on the list falls back to the posting date."""
    spec = P.SearchSpec.postings(agencies=["BUILDING"], order_by="o_comment; DROP TABLE jobs")
    return S.search(transform_postings(raw_frame(spark, sf_dir)), spec).page.select("id", "posted_date")


@register("registered_view", postings_cte_sql() + "SELECT agency, count(*) AS n FROM postings WHERE posting_type = 'External' GROUP BY 1")
def registered_view(spark, sf_dir):
    """The newest table as the view ``jobs``, asked in SQL."""
    SRC.register_view(transform_postings(raw_frame(spark, sf_dir)), "jobs")
    return SRC.adhoc_sql(spark, "SELECT agency, count(*) AS n FROM jobs WHERE posting_type = :kind GROUP BY agency", args={"kind": "External"})


_LATEST = P.SearchSpec.ui_default(agencies=["BUILDING", "AUTOMOBILE"], salary_min=50000, order_by="salary_range_from")


@register(
    "pipeline_search_latest",
    postings_cte_sql()
    + f"""
    SELECT {", ".join(_PAGE_COLS)} FROM postings
    WHERE processed_date = (SELECT max(processed_date) FROM postings) AND posting_type = 'External'
      AND agency IN ('BUILDING', 'AUTOMOBILE') AND salary_range_to >= 50000
    ORDER BY salary_range_from DESC NULLS LAST, id LIMIT 25
    """,
)
def pipeline_search_latest(spark, sf_dir):
    """G5 over S9: state -> partition -> page, with the page's opening choices."""
    return S.search(SRC.load_latest(spark, _processed(spark, sf_dir)), _LATEST).page.select(*_PAGE_COLS)
