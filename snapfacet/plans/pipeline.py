"""Pipeline jobs: G2 (process latest), G3 (reprocess all), G4 (rebuild history).

Folder layout and snapshot keys: see ``sources.snapshots``. The gate compares folder names: new
are the landed snapshots without a processed folder. Their keys are a partition filter on the raw
scan, so a daily run reads the raw files of the new snapshots, once, and not the history. All
snapshots of a run are transformed in one job and written with one dynamic partition overwrite: no
delete-first, and a failed run leaves the previous partitions in place. History and state are
published in versions (``sources.versions``): readers find the one before until the new one is whole. The
state is written last and never goes back to an older snapshot.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.identity import row_hash
from ..sources import snapshots as SRC
from . import quality as Q
from .transform import history_columns, transform_postings


@dataclass
class RunResult:
    message: str
    snapshots: list
    records: int
    rejected: int = 0


def index_path(root: str, snapshot: str) -> str:
    return f"{root}/index/{SRC.SNAPSHOT}={snapshot}"


def build_snapshot_index(spark: SparkSession, root: str, snapshot: str, stemmer: bool = True, stop_words: bool | list = True):
    """The full-text index of one processed snapshot, built in the pipeline (the
    reference builds it in the browser on every page load) and stored next to the data. ``stop_words``: True for Spark's
    English list, or a list (``text_index.read_stop_words``)."""
    from ..operators import text_index as X
    from ..schema import INDEX_COLUMNS

    rows = spark.read.parquet(f"{root}/processed").where(F.col(SRC.SNAPSHOT) == F.lit(snapshot))
    sw = X.english_stop_words() if stop_words is True else stop_words or None
    return X.build_text_index(rows, "id", INDEX_COLUMNS, sw, stemmer).save(index_path(root, snapshot))


def load_latest_index(spark: SparkSession, root: str):
    """The stored index of the snapshot the state points to."""
    from ..operators.text_index import TextIndex

    st = SRC.read_state(spark, root).first()
    if st is None or st["snapshot"] is None:
        raise ValueError("state names no snapshot: nothing dated processed yet")
    return TextIndex.load(spark, index_path(root, st["snapshot"]))


def segment_index(spark: SparkSession, root: str, stemmer: bool = True, stop_words: bool = True):
    """E2, kept across snapshots: the index of processed contents (``operators.segments``)."""
    from ..operators import text_index as X
    from ..operators.segments import SegmentedIndex
    from ..schema import INDEX_COLUMNS

    return SegmentedIndex(spark, f"{root}/index_segments", INDEX_COLUMNS, "content_id", X.english_stop_words() if stop_words else (), stemmer)


def with_content_id(rows: DataFrame) -> DataFrame:
    """Processed rows with the hash that follows a posting across snapshots (``transform_postings`` makes the same)."""
    body = [c for c in rows.columns if c not in ("id", "processed_date", SRC.SNAPSHOT)]
    return rows.withColumn("content_id", row_hash(body, rows))


def update_segment_index(spark: SparkSession, root: str, snapshot: str, **kw):
    """Bring the kept index to the contents of one processed snapshot: only new contents are tokenised."""
    rows = spark.read.parquet(f"{root}/processed").where(F.col(SRC.SNAPSHOT) == F.lit(snapshot))
    return segment_index(spark, root, **kw).add_snapshot(with_content_id(rows), snapshot)


def update_intervals(spark: SparkSession, root: str, snapshots: list[str]):
    """Merge processed snapshots into the stored table of validity intervals (``operators.intervals``)."""
    from ..operators.intervals import IntervalTable

    intervals = IntervalTable(spark, f"{root}/intervals")
    stored = spark.read.parquet(f"{root}/processed")
    for key in sorted(snapshots):
        intervals.add(with_content_id(stored.where(F.col(SRC.SNAPSHOT) == F.lit(key))), key)
    return intervals


def _order(snapshot: str):
    """Snapshots by the time they name; those that name none come first."""
    time = SRC.snapshot_time(snapshot)
    return (time is not None, time or dt.datetime.min, snapshot)


def _process(
    spark: SparkSession,
    root: str,
    keys: list[str],
    full_history: bool,
    fetched_at: dt.datetime | None,
    build_index: bool | str,
    lenient: bool,
    multiline: bool,
    quarantine: bool = False,
) -> RunResult:
    if quarantine:
        records, rejected = _write_good(spark, root, keys, multiline)
        if not any(records.values()):
            return RunResult("No good records", sorted(keys), 0, rejected)
        stored = spark.read.parquet(f"{root}/processed")
        keys = [k for k in keys if records[k]]
        written = stored.where(F.col(SRC.SNAPSHOT).isin(keys))
    else:
        rejected, raw = 0, SRC.read_raw(spark, root, multiline, keys)
        SRC.write_processed(transform_postings(raw, lenient=lenient, carry=(SRC.SNAPSHOT,)), root)
        # Counts per written snapshot: the keys are partition folders, the count reads only
        # Parquet footers. One row per snapshot comes back to the driver.
        stored = spark.read.parquet(f"{root}/processed")
        written = stored.where(F.col(SRC.SNAPSHOT).isin(keys))
        counts = written.groupBy(F.col(SRC.SNAPSHOT).cast("string").alias("k")).agg(F.count(F.lit(1)).alias("n")).collect()
        records = {r["k"]: int(r["n"]) for r in counts}
    SRC.write_history(history_columns(stored if full_history else written), root, full=full_history)
    before = SRC.read_state(spark, root).first()
    newest = max((k for k in keys if SRC.snapshot_time(k)), key=_order, default=None)
    if build_index == "segments" and newest is not None and (before["snapshot"] is None or _order(newest) >= _order(before["snapshot"])):
        update_segment_index(spark, root, newest)  # a late snapshot is not what is searched
    elif build_index and build_index != "segments" and newest is not None:
        build_snapshot_index(spark, root, newest)
    if before["snapshot"] is not None and (newest is None or _order(before["snapshot"]) > _order(newest)):
        newest, count = before["snapshot"], before["record_count"]  # a late snapshot does not move the state back
    else:
        count = records.get(newest, 0) if newest is not None else None
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    time = SRC.snapshot_time(newest) if newest is not None else None
    SRC.write_state(spark, root, time, fetched_at or before["last_fetched_at"] or now, now, count, newest)
    return RunResult("OK", sorted(keys), sum(records.values()), rejected)


def _write_good(spark: SparkSession, root: str, keys: list[str], multiline: bool) -> tuple[dict[str, int], int]:
    """Write the good records of the snapshots and set the bad ones aside: (records written per snapshot, records
    set aside). One job, and a second one only where there are bad records."""
    records, rejected = {}, 0
    for lo in range(0, len(keys), Q.MOST):
        counted = Q.Counted(SRC.read_raw(spark, root, multiline, keys[lo : lo + Q.MOST], keep_corrupt=True), keys[lo : lo + Q.MOST])
        SRC.write_processed(transform_postings(counted.good, carry=(SRC.SNAPSHOT,)), root)
        counts = counted.counts()
        records |= {k: good for k, (good, _) in counts.items()}
        bad = sum(b for _, b in counts.values())
        if bad:
            Q.write_quarantine(counted.bad, root)
        rejected += bad
    return records, rejected


def run_latest(
    spark: SparkSession,
    root: str,
    lenient: bool = False,
    build_index: bool | str = False,
    multiline: bool = False,
    fetched_at: dt.datetime | None = None,
    quarantine: bool = False,
) -> RunResult:
    """Process every landed raw snapshot that has no processed folder yet. ``build_index``: True builds the
    index of the newest snapshot, "segments" brings the kept one to it.

    The gate tests the *processed* keys (not the raw ones), so a snapshot whose processing
    failed is taken up again by the next run. ``multiline`` reads JSON array files. ``quarantine`` sets bad records
    aside instead of failing at them (``plans.quality``)."""
    done = set(SRC.list_keys(spark, f"{root}/processed"))
    keys = [k for k in SRC.list_keys(spark, f"{root}/raw") if k not in done]
    if not keys:
        return RunResult("No new data", [], 0)
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    return _process(spark, root, keys, False, fetched_at or now, build_index, lenient, multiline, quarantine)


def reprocess_all(
    spark: SparkSession, root: str, lenient: bool = False, build_index: bool | str = False, multiline: bool = False
) -> RunResult:
    """Every raw snapshot again, history rebuilt, state from the newest. The time of the last
    fetch stays: nothing was fetched."""
    keys = SRC.list_keys(spark, f"{root}/raw")
    if not keys:
        return RunResult("No raw files to process", [], 0)
    res = _process(spark, root, keys, True, None, build_index, lenient, multiline)
    res.message = f"Reprocessed {len(res.snapshots)} snapshots"
    return res


def rebuild_history(spark: SparkSession, root: str) -> DataFrame:
    """The history table from all processed snapshots."""
    SRC.write_history(history_columns(SRC.read_processed(spark, root)), root, full=True)
    return SRC.read_history(spark, root)
