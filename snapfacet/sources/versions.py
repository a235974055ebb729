"""Versioned tables: a new version is written beside the old one and published by one small record, so
that readers find a whole version at any time (S7, S8).

Layout of a table under ``path``::

    <path>/version=<number>-<unique>/<key>=<value>/part-*.parquet    the rows that a version wrote
    <path>_commits/commit=<number>-<unique>/part-*.json              one record per version

A record names its version and the folders that make the table up: those of this version, and for an
incremental version those of earlier ones whose keys it does not replace. It is one file, written when the rows are all
there, and a file appears whole or not at all. Nothing is overwritten or deleted: a writer that dies leaves rows
that no record names, or no record; either way the version before is the current one. Two writers at once take
different folders; the larger (number, unique part) is current. ``unreferenced`` lists what the newest records do not
name, for cleaning up when no reader is left.

Reading a partitioned table reads the named folders only; a filter on the key prunes them further.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VERSION = "version"
RECORD = "number long, id string, key string, folders array<struct<key: string, folder: string>>, note string"


def is_missing(error: AnalysisException) -> bool:
    """Whether a read failed since nothing is there (any other failure is an error)."""
    return (error.getCondition() or "").startswith(("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"))


@dataclass(frozen=True)
class Version:
    number: int
    id: str
    key: str | None
    #: (key, folder) for each partition, or one folder without a key; folders are relative to the table.
    folders: tuple
    note: str | None


def versions(spark: SparkSession, path: str) -> list[Version]:
    """All published versions, oldest first: one small record each."""
    try:
        records = spark.read.schema(RECORD).option("recursiveFileLookup", "true").json(f"{path}_commits").where("id IS NOT NULL").collect()
    except AnalysisException as e:
        if is_missing(e):
            return []
        raise
    found = (Version(r["number"], r["id"], r["key"], tuple((f["key"], f["folder"]) for f in r["folders"]), r["note"]) for r in records)
    return sorted(found, key=lambda v: (v.number, v.id))


def current(spark: SparkSession, path: str) -> Version | None:
    """The newest published version."""
    every = versions(spark, path)
    return every[-1] if every else None


def write(spark: SparkSession, path: str, df: DataFrame, key: str | None = None) -> tuple[str, tuple]:
    """Write rows into a folder of their own; nothing is published yet. Returns the version's id and its folders."""
    last = current(spark, path)
    id_ = f"{(last.number if last else 0) + 1:09d}-{uuid.uuid4().hex[:12]}"
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(key) if key else writer).parquet(f"{path}/{VERSION}={id_}")
    if key is None:
        return id_, ((None, f"{VERSION}={id_}"),)
    # one row per partition; folder names only, no file is opened
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    names = files.load(f"{path}/{VERSION}={id_}").select(F.regexp_extract("path", f"/({key}=[^/]*)/[^/]*$", 1).alias("n")).distinct().collect()
    return id_, tuple(sorted((r["n"].partition("=")[2], f"{VERSION}={id_}/{r['n']}") for r in names if r["n"]))


def publish(spark: SparkSession, path: str, id_: str, folders: tuple, key: str | None = None, keep: bool = False, note: str | None = None) -> Version:
    """Make a written version current. ``keep``: the partitions of the version before stay, but for the keys that this one has."""
    last = current(spark, path)
    mine = {k for k, _ in folders}
    if keep and last is not None:
        folders = tuple(sorted([*folders, *((k, f) for k, f in last.folders if k not in mine)], key=lambda f: (f[0] or "", f[1])))
    number = max(int(id_.partition("-")[0]), (last.number if last else 0) + 1)
    record = spark.createDataFrame([(number, id_, key, [{"key": k, "folder": f} for k, f in folders], note)], RECORD)
    record.coalesce(1).write.json(f"{path}_commits/commit={number:09d}-{id_.partition('-')[2]}")
    return Version(number, id_, key, folders, note)


def replace(spark: SparkSession, path: str, df: DataFrame, key: str | None = None, keep: bool = False, note: str | None = None) -> Version:
    """Write and publish."""
    id_, folders = write(spark, path, df, key)
    return publish(spark, path, id_, folders, key, keep, note)


def read(spark: SparkSession, path: str, version: Version | None = None, schema=None) -> DataFrame:
    """The rows of a version (None: of the current one), its key as text."""
    version = version or current(spark, path)
    if version is None:
        raise ValueError(f"{path} has no published version")
    folders = [f"{path}/{f}" for _, f in version.folders]
    reader = spark.read.option("basePath", path)
    if not folders:
        if schema is None:
            raise ValueError(f"{path}: version {version.id} has no rows; give a schema")
        return spark.createDataFrame([], schema)
    df = (reader.schema(schema) if schema is not None else reader).parquet(*folders).drop(VERSION)
    return df.withColumn(version.key, F.col(version.key).cast("string")) if version.key in df.columns else df


def unreferenced(spark: SparkSession, path: str, keep_last: int = 1) -> list[str]:
    """Folders of the table that none of the last versions names."""
    every = versions(spark, path)
    named = {f for v in every[-keep_last:] for _, f in v.folders}
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    except AnalysisException as e:
        if is_missing(e):
            return []
        raise
    folder = F.regexp_extract("path", f"/({VERSION}=.*)/[^/]*$", 1)
    return sorted(r["f"] for r in files.select(folder.alias("f")).distinct().collect() if r["f"] and r["f"] not in named)
