"""Registered queries: snapshots and history.

The driver tables hold no postings; ``events`` stands in for a snapshot stream: the day
of ``ts`` is the snapshot key.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import history as H
from ..operators.intervals import IntervalTable
from ..session import scratch, table
from ..sources import snapshots as SRC
from .registry import register


def _events_by_day(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.withColumn("day", F.to_date("ts"))


@register(
    "history_union",
    """
    SELECT event_id, ts, user_id, event_type, value, CAST(ts AS DATE) AS day FROM events
    """,
)
def history_union(spark, sf_dir):
    """Snapshots written one by one as partitioned files and read back as one table."""
    from ..plans.transform import history_columns

    root = scratch(spark, "history")
    _events_by_day(spark, sf_dir).withColumn(SRC.SNAPSHOT, F.col("day").cast("string")).write.partitionBy(SRC.SNAPSHOT).parquet(f"{root}/processed")
    return history_columns(SRC.read_processed(spark, root), exclude=("props", SRC.SNAPSHOT))


@register(
    "latest_snapshot",
    """
    SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS day FROM events
    WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)
    """,
)
def latest_snapshot(spark, sf_dir):
    e = _events_by_day(spark, sf_dir)
    return H.latest_snapshot(e, "day").select("event_id", "user_id", "event_type", "day")


# Keys already processed (a parameter of the gate, like a listing of processed folders).
_EXISTING = [dt.date(2024, 1, d) for d in range(1, 21)]


@register(
    "snapshot_gate",
    """
    SELECT DISTINCT CAST(ts AS DATE) AS day FROM events
    WHERE CAST(ts AS DATE) NOT IN (SELECT CAST(DATE '2024-01-01' + INTERVAL (i) DAY AS DATE) FROM range(20) t(i))
    """,
)
def snapshot_gate(spark, sf_dir):
    incoming = _events_by_day(spark, sf_dir)
    existing = spark.createDataFrame([(d,) for d in _EXISTING], "day date")
    return H.snapshot_gate(incoming, existing, "day")


@register(
    "snapshot_counts",
    "SELECT CAST(ts AS DATE) AS day, count(*) AS record_count FROM events GROUP BY 1",
)
def snapshot_counts(spark, sf_dir):
    return H.snapshot_counts(_events_by_day(spark, sf_dir), "day")


_REKEY_FILES_SQL = """
    WITH rec AS (
      SELECT event_id, strftime(ts, '%Y-%m-%dT00:00:00.000') AS process_date,
             CASE WHEN user_id = 0
                  THEN 'raw/' || strftime(ts, '%Y-%m-%dT00:00:00') || '+00:00.json'
                  ELSE 'raw/u' || CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y-%m-%d') || '.json' END AS file
      FROM events),
    files AS (
      SELECT file, 'raw/' || strftime(CAST(split_part(arg_min(process_date, event_id), '.', 1) AS TIMESTAMP), '%Y-%m-%dT%H:%M:%S')
                    || '+00:00.json' AS target
      FROM rec GROUP BY file),
    keep AS (SELECT target, coalesce(max(CASE WHEN file = target THEN file END), min(file)) AS keeper
             FROM files WHERE target IS NOT NULL GROUP BY target)
"""


@register(
    "rekey_plan",
    _REKEY_FILES_SQL
    + """
    SELECT f.file, f.target,
           CASE WHEN f.target IS NULL THEN 'SKIP' WHEN f.file = f.target THEN 'SKIP'
                WHEN f.file = k.keeper THEN 'RENAME' ELSE 'DELETE' END AS action
    FROM files f LEFT JOIN keep k ON f.target = k.target
    """,
)
def rekey_plan(spark, sf_dir):
    rec = _rekey_records(spark, sf_dir)
    return H.rekey_plan(H.file_targets(rec, "file", "event_id", "process_date", prefix="raw/", suffix=".json"))


def _rekey_records(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    day_text = F.date_format("ts", "yyyy-MM-dd'T'00:00:00.000")
    file = F.when(
        F.col("user_id") == 0,
        F.concat(F.lit("raw/"), F.date_format("ts", "yyyy-MM-dd'T'00:00:00"), F.lit("+00:00.json")),
    ).otherwise(F.concat(F.lit("raw/u"), F.col("user_id").cast("string"), F.lit("-"), F.date_format("ts", "yyyy-MM-dd"), F.lit(".json")))
    return e.select("event_id", day_text.alias("process_date"), file.alias("file"))


@register(
    "history_metrics",
    """
    WITH pairs AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events),
    seq AS (SELECT day, row_number() OVER (ORDER BY day) AS s FROM (SELECT DISTINCT day FROM pairs)),
    p AS (SELECT pairs.user_id, seq.s FROM pairs JOIN seq USING (day)),
    present AS (SELECT s, count(*) AS n FROM p GROUP BY s),
    new AS (SELECT a.s, count(*) AS n FROM p a LEFT JOIN p b ON a.user_id = b.user_id AND b.s = a.s - 1
            WHERE b.user_id IS NULL GROUP BY a.s),
    gone AS (SELECT a.s + 1 AS s, count(*) AS n FROM p a LEFT JOIN p b ON a.user_id = b.user_id AND b.s = a.s + 1
             WHERE b.user_id IS NULL GROUP BY a.s)
    SELECT seq.day, coalesce(present.n, 0) AS present, coalesce(new.n, 0) AS new, coalesce(gone.n, 0) AS gone
    FROM seq LEFT JOIN present USING (s) LEFT JOIN new USING (s) LEFT JOIN gone USING (s)
    """,
)
def history_metrics(spark, sf_dir):
    return H.history_metrics(_events_by_day(spark, sf_dir), "day", "user_id")


@register(
    "days_open",
    """
    SELECT user_id, min(d) AS first_seen, max(d) AS last_seen, count(*) AS snapshots, CAST(max(d) - min(d) + 1 AS BIGINT) AS days_open
    FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events) GROUP BY user_id
    """,
)
def days_open(spark, sf_dir):
    return H.days_open(_events_by_day(spark, sf_dir), "day", "user_id")


# Weekly snapshots of what each user does of each kind in each quarter of a day: on which weekday it first came.
_WEEKLY_SQL = """
    WITH s AS (
      SELECT strftime(date_trunc('week', ts), '%Y-%m-%d') AS k, user_id || '-' || event_type || '-' || (hour(ts) // 6) AS job_id,
             strftime(min(ts), '%w') AS content_id FROM events GROUP BY 1, 2),
    seq AS (SELECT k, row_number() OVER (ORDER BY k) AS n FROM (SELECT DISTINCT k FROM s))
"""


def _weekly_intervals(spark, sf_dir):
    """The interval table of the weeks, merged in one by one; the second week comes last."""
    e = table(spark, sf_dir, "events")
    job = F.concat_ws("-", F.col("user_id").cast("string"), "event_type", F.floor(F.hour("ts") / 6).cast("string"))
    week = F.date_format(F.date_trunc("week", "ts"), "yyyy-MM-dd")
    weekly = e.groupBy(week.alias("k"), job.alias("job_id")).agg((F.dayofweek(F.min("ts")) - 1).cast("string").alias("content_id"))
    weekly.write.parquet(path := scratch(spark, "weeks"))
    weekly = spark.read.parquet(path)
    weeks = sorted(r["k"] for r in weekly.select("k").distinct().collect())
    out = IntervalTable(spark, scratch(spark, "intervals"))
    for k in [*weeks[:1], *weeks[2:], *weeks[1:2]]:
        out.add(weekly.where(F.col("k") == k), k)
    return out


@register(
    "history_intervals",
    _WEEKLY_SQL
    + """,
    p AS (SELECT job_id, content_id, n, n - row_number() OVER (PARTITION BY job_id, content_id ORDER BY n) AS g FROM s JOIN seq USING (k)),
    i AS (SELECT job_id, content_id, min(n) AS a, max(n) AS b FROM p GROUP BY job_id, content_id, g)
    SELECT job_id, content_id, f.k AS first_seen, l.k AS last_seen, f.k AS valid_from, x.k AS valid_to
    FROM i JOIN seq f ON f.n = a JOIN seq l ON l.n = b LEFT JOIN seq x ON x.n = b + 1
    """,
)
def history_intervals(spark, sf_dir):
    """When each entity had which content, merged snapshot by snapshot, one of them late."""
    return _weekly_intervals(spark, sf_dir).intervals()


@register(
    "history_changes",
    _WEEKLY_SQL
    + """,
    j AS (SELECT job_id, n, content_id FROM s JOIN seq USING (k)),
    b AS (SELECT *, lag(n) OVER w AS pn, lag(content_id) OVER w AS pc FROM j WINDOW w AS (PARTITION BY job_id ORDER BY n)),
    c AS (
      SELECT n, job_id, CASE WHEN pn IS NULL THEN 'new' WHEN pn < n - 1 THEN 'reopened' WHEN pc <> content_id THEN 'changed' END AS change, 1 AS contents FROM b
      UNION ALL
      SELECT j.n + 1, j.job_id, 'closed', 0 FROM j LEFT JOIN j x ON x.job_id = j.job_id AND x.n = j.n + 1 WHERE x.job_id IS NULL)
    SELECT seq.k AS snapshot, job_id, change, contents FROM c JOIN seq USING (n) WHERE change IS NOT NULL AND n > 1
    """,
)
def history_changes(spark, sf_dir):
    """New, reopened, changed and closed entities of each snapshot."""
    return _weekly_intervals(spark, sf_dir).changes()


@register(
    "rekeyed_records",
    _REKEY_FILES_SQL
    + """
    SELECT r.event_id, CASE WHEN f.file = f.target OR f.target IS NULL THEN f.file ELSE f.target END AS file
    FROM rec r JOIN files f ON r.file = f.file LEFT JOIN keep k ON f.target = k.target
    WHERE f.target IS NULL OR f.file = f.target OR f.file = k.keeper
    """,
)
def rekeyed_records(spark, sf_dir):
    """The records that stay after the re-key, under their new file names."""
    rec = _rekey_records(spark, sf_dir)
    plan = H.rekey_plan(H.file_targets(rec, "file", "event_id", "process_date", prefix="raw/", suffix=".json"))
    return H.rekeyed(rec, plan).select("event_id", "file")


@register(
    "adhoc_sql",
    """
    SELECT lang, count(*) AS n, sum(n_chars) AS chars FROM documents
    WHERE n_chars >= 200 GROUP BY lang
    """,
)
def adhoc_sql(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return SRC.adhoc_sql(
        spark,
        "SELECT lang, count(*) AS n, sum(n_chars) AS chars FROM docs WHERE n_chars >= :min_chars GROUP BY lang",
        views={"docs": docs},
        args={"min_chars": 200},
    )


@register("intake_stream", "SELECT DISTINCT event_id, user_id, event_type, CAST(ts AS DATE) AS day FROM events")
def intake_stream(spark, sf_dir):
    """The events land as JSON files per day; a file stream with availableNow takes
    them in batch by batch and writes day partitions (idempotent per day)."""
    return _intake(spark, sf_dir, 1)


@register("intake_twice", "SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS day FROM events")
def intake_twice(spark, sf_dir):
    """Every snapshot landed and taken in twice is there once."""
    return _intake(spark, sf_dir, 2)


@register(
    "intake_late_file",
    "SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS day FROM events",
)
def intake_late_file(spark, sf_dir):
    """R1 with keyed state: the mornings of all days land first, the afternoons as late files of the same snapshots, and the mornings once
    more; each record is taken in once."""
    from ..streaming.keyed_intake import run_keyed_intake

    e = _events_by_day(spark, sf_dir)
    texts = e.select(*(F.col(c).cast("string").alias(c) for c in ("event_id", "user_id", "event_type")), "day", (F.hour("ts") < 12).alias("_morning"))
    first, late = texts.where("_morning").drop("_morning"), texts.where("NOT _morning").drop("_morning")
    out, _ = run_keyed_intake(spark, [(first, True), (late, True), (first, True)], "day")
    return out.select(F.col("event_id").cast("long").alias("event_id"), F.col("user_id").cast("long").alias("user_id"), "event_type", "day")


def _intake(spark, sf_dir, times):
    from ..streaming.intake import run_intake

    e = _events_by_day(spark, sf_dir).select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("user_id").cast("string").alias("user_id"),
        "event_type",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("process_date"),
        "day",
    )
    return run_intake(spark, e, key="day", times=times)
