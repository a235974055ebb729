"""Sources and sinks of snapshot data: S1-S12.

Layout under a root folder (any Hadoop file system: local, HDFS, object stores)::

    raw/snapshot=<key>/part-*.json            one JSON object per line, or one JSON array
    processed/snapshot=<key>/part-*.parquet
    history/version=<v>/snapshot=<key>/...    processed minus long texts, in versions (see ``versions``)
    state/version=<v>/part-*.json             pipeline state, a new one-row file at each run

The key of a snapshot is the full timestamp of its process date (``2026-01-26T00-00-00``: colons
break Hadoop globbing), so two snapshots of one day are two snapshots; records without a date land
under ``undated``. All tables are partitioned by that key, so the gate compares folder names and a
run reads the folders of new snapshots only. Large snapshots must be landed as JSON lines: a JSON
array file can only be read by one task.
"""

from __future__ import annotations

import datetime as dt
import uuid
from typing import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import RAW, STATE
from . import versions as V
from .lookup import bloom_options

SNAPSHOT = "snapshot"
UNDATED = "undated"
CORRUPT_COL = "_bad"
# Fixed value of the source pull: page size.
PAGE_SIZE = 10_000


def snapshot_key_of(date_text: Column) -> Column:
    """The snapshot key of a process date text (``undated`` where it is null or empty)."""
    whole = F.replace(F.substring_index(F.trim(date_text), ".", 1), F.lit(":"), F.lit("-"))
    return F.when(F.length(F.trim(date_text)) > 0, whole).otherwise(F.lit(UNDATED))


def snapshot_time(key: str) -> dt.datetime | None:
    """The time that a snapshot key names; None for other keys (``undated``)."""
    day, _, clock = key.partition("T")
    try:
        return dt.datetime.fromisoformat(f"{day}T{clock.replace('-', ':')}" if clock else day)
    except ValueError:
        return None


def list_keys(spark: SparkSession, path: str, key: str = SNAPSHOT) -> list[str]:
    """Snapshot keys present under a partitioned folder: folder names only, no file is opened
    (the ``binaryFile`` listing without its content). One value per snapshot comes back."""
    try:
        files = spark.read.format("binaryFile").load(path)
        if key not in files.columns:
            return []
        return sorted(r[0] for r in files.select(F.col(key).cast("string")).distinct().collect())
    except AnalysisException as e:
        if V.is_missing(e):
            return []
        raise


def read_raw_snapshot(spark: SparkSession, path: str, multiline: bool = False, keep_corrupt: bool = False) -> DataFrame:
    """Raw records with the explicit all-string schema (absent keys are null).

    ``multiline=True`` reads JSON array files (one task per file); the default reads JSON
    lines, which split into many tasks. ``keep_corrupt`` keeps unparseable records in a
    ``_bad`` column instead of failing."""
    schema = T.StructType(RAW.fields + ([T.StructField(CORRUPT_COL, T.StringType(), True)] if keep_corrupt else []))
    reader = spark.read.schema(schema)
    reader = reader.option("multiLine", multiline).option("mode", "PERMISSIVE" if keep_corrupt else "FAILFAST")
    if keep_corrupt:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COL)
    return reader.json(path)


def read_landed_pages(
    spark: SparkSession, path: str, page_size: int = PAGE_SIZE, multiline: bool = False
) -> tuple[DataFrame, DataFrame]:
    """A snapshot pulled page by page (limit/offset) and landed as one file per page.

    Returns the records and a page report ``(page_file, page, records, full, last, ok)``: every page
    but the last must be full. The last page is the one with the largest number in its file name
    (``page-10`` comes after ``page-9``), or of its folder ``page=<number>``. Exact duplicate records across pages (the source gives no
    order) are reported by :func:`duplicate_records`, never dropped."""
    df = read_raw_snapshot(spark, path, multiline).withColumn("_page", F.col("_metadata.file_path"))
    report = df.groupBy("_page").agg(F.count(F.lit(1)).alias("records"))
    name = F.element_at(F.split("_page", "/"), -1)
    folder, file = F.regexp_extract("_page", "/page=([0-9]+)/[^/]*$", 1), F.regexp_extract(name, "([0-9]+)[^0-9]*$", 1)
    number = F.try_to_number(F.when(folder != "", folder).otherwise(file), F.lit("9" * 18)).cast("long")
    report = report.withColumn("page", number).withColumn("full", F.col("records") == F.lit(page_size))
    last = report.agg(F.max(F.struct("page", "_page"))["_page"]).scalar()
    report = report.withColumn("last", F.col("_page") == last).withColumn("ok", F.col("full") | F.col("last"))
    return df.select(*(f.name for f in RAW.fields)), report.withColumnRenamed("_page", "page_file")


def duplicate_records(df: DataFrame) -> DataFrame:
    """Exact duplicate records with their multiplicity (an aggregate, partial per task)."""
    cols = [c for c in df.columns]
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def probe_snapshot_date(df: DataFrame, column: str = "process_date") -> DataFrame:
    """S3: the snapshot date of a pull, checked to be one value: ``(process_date,
    n_dates)``; ``process_date`` is null when the column is absent or empty."""
    if column not in df.columns:
        return df.sparkSession.createDataFrame([(None, 0)], "process_date string, n_dates long")
    return df.agg(F.max(column).alias("process_date"), F.count_distinct(column).alias("n_dates"))


def with_snapshot_partition(df: DataFrame, source: str = "process_date", key: str = SNAPSHOT) -> DataFrame:
    """The snapshot key of each raw record."""
    return df.withColumn(key, snapshot_key_of(F.col(source)))


def write_raw(df: DataFrame, root: str, key: str = SNAPSHOT) -> None:
    """Land raw records under their snapshot key; re-landing a key replaces only that
    key (dynamic partition overwrite)."""
    if key not in df.columns:
        df = with_snapshot_partition(df, key=key)
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).json(f"{root}/raw")


def read_raw(spark: SparkSession, root: str, multiline: bool = False, keys: list[str] | None = None, keep_corrupt: bool = False) -> DataFrame:
    """Landed raw records with their snapshot key; ``keys`` becomes a partition filter, so other
    snapshots' files are not read. ``keep_corrupt``: records that are no JSON come with their text in ``_bad``."""
    broken = [T.StructField(CORRUPT_COL, T.StringType(), True)] if keep_corrupt else []
    schema = T.StructType([*RAW.fields, *broken, T.StructField(SNAPSHOT, T.StringType(), True)])
    reader = spark.read.schema(schema).option("multiLine", multiline).option("mode", "PERMISSIVE" if keep_corrupt else "FAILFAST")
    if keep_corrupt:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COL)
    raw = reader.json(f"{root}/raw")
    return raw if keys is None else raw.where(F.col(SNAPSHOT).isin(keys))


def write_processed(df: DataFrame, root: str, key: str = SNAPSHOT) -> None:
    """Processed rows as ZSTD Parquet partitioned by snapshot, with bloom filters on the row id."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .options(**bloom_options([c for c in ("id",) if c in df.columns]))
        .partitionBy(key)
        .parquet(f"{root}/processed")
    )


def _key_as_text(df: DataFrame, key: str = SNAPSHOT) -> DataFrame:
    """Folder names that look like dates come back as dates: as text, a key is what was written."""
    return df.withColumn(key, F.col(key).cast("string")) if key in df.columns else df


def read_processed(spark: SparkSession, root: str, merge_schema: bool = False) -> DataFrame:
    """All processed snapshots, with their key as text."""
    return _key_as_text(spark.read.option("mergeSchema", merge_schema).parquet(f"{root}/processed"))


def read_history(spark: SparkSession, root: str) -> DataFrame:
    """The history table as last published, with the snapshot key as text."""
    return V.read(spark, f"{root}/history")


def write_history(df: DataFrame, root: str, key: str = SNAPSHOT, full: bool = True) -> None:
    """The history table. ``full=True`` rebuilds it (reference behaviour, G4); else
    only the snapshots present in ``df`` are replaced (incremental). Either way the rows go to a new version,
    which readers see when it is published: a rebuild that fails, or is under way, leaves the history as it was."""
    V.replace(df.sparkSession, f"{root}/history", df, key, keep=not full)


def read_state(spark: SparkSession, root: str) -> DataFrame:
    """The one-row state last written; an empty state (all nulls) when none was written yet. A version
    without its file, or with a broken one, is passed over. Any other failure to read it is an error."""
    broken = T.StructField(CORRUPT_COL, T.StringType(), True)
    try:
        every = spark.read.schema(T.StructType([*STATE.fields, broken])).option("columnNameOfCorruptRecord", CORRUPT_COL)
        every = every.option("recursiveFileLookup", "true").json(f"{root}/state").select("*", F.col("_metadata.file_path").alias("_file"))
        # the version is in the folder's name; a file from before there were versions has none and is the oldest
        number = F.regexp_extract("_file", "/version=([^/]*)/[^/]*$", 1)
        last = every.where(F.col(CORRUPT_COL).isNull()).orderBy(number.desc()).limit(1).drop("_file", CORRUPT_COL)
        if row := last.first():
            return spark.createDataFrame([row], STATE)
    except AnalysisException as e:
        if not V.is_missing(e):
            raise
    return empty_state(spark)


def empty_state(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(None,) * len(STATE.fields)], STATE)


def write_state(
    spark: SparkSession,
    root: str,
    source_updated_at: dt.datetime | None,
    last_fetched_at: dt.datetime | None,
    last_processed_at: dt.datetime | None,
    record_count: int | None,
    snapshot: str | None = None,
) -> None:
    """The state is written last, so readers switch only when everything is written. Each state is a new
    one-row file, named by the time of writing: there is no moment without a state."""
    row = [(source_updated_at, last_fetched_at, last_processed_at, record_count, snapshot)]
    version = f"{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S.%f}-{uuid.uuid4().hex[:8]}"
    spark.createDataFrame(row, STATE).coalesce(1).write.json(f"{root}/state/version={version}")


def load_latest(spark: SparkSession, root: str, key: str = SNAPSHOT) -> DataFrame:
    """The processed snapshot named by the state; an error when the state names none. The
    state's key is compared as text (no time zone), and the filter prunes to one folder."""
    st = read_state(spark, root).first()
    if st is None or st["snapshot"] is None:
        raise ValueError("state names no snapshot: nothing dated processed yet")
    return spark.read.parquet(f"{root}/processed").where(F.col(key) == F.lit(st["snapshot"]))


def register_view(df: DataFrame, name: str = "jobs", cache: bool = False) -> DataFrame:
    """The table as a temp view, optionally cached (columnar) for repeated searches."""
    if cache:
        df = df.cache()
    df.createOrReplaceTempView(name)
    return df


def adhoc_sql(spark: SparkSession, text: str, views: Mapping[str, DataFrame] | None = None, args: Mapping | None = None) -> DataFrame:
    """Ad-hoc SQL over registered views; values are bound as named parameters."""
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)
    return spark.sql(text, args=dict(args or {}))


def list_snapshots(spark: SparkSession, path: str, key: str = SNAPSHOT) -> DataFrame:
    """Snapshot keys present under a partitioned folder, one row each (folder names only)."""
    return spark.createDataFrame([(k,) for k in list_keys(spark, path, key)], f"{key} string")


def list_files(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """S12 by file: the files of a format under a folder, by their names' ending; none is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*.{fmt}")
    return files.load(path).select(F.col("path").alias("file"))
