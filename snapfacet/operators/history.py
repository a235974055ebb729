"""Snapshot history operators: A5, A6, J1, U1, W1, E3.

A snapshot is the set of rows sharing one snapshot key (the partition column
``processed_date`` of the processed table, or a key derived from a timestamp).
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.casts import snapshot_key


def latest_key(df: DataFrame, key: str):
    """A5 as a Column: the newest snapshot key, planned as a scalar subquery (evaluated
    once, before the filter that uses it; on a partitioned table it prunes partitions)."""
    return df.select(F.max(key)).scalar()


def latest_snapshot(df: DataFrame, key: str) -> DataFrame:
    """A5 + S9: the rows of the newest snapshot."""
    return df.where(F.col(key) == latest_key(df, key))


def snapshot_counts(df: DataFrame, key: str, alias: str = "record_count") -> DataFrame:
    """Records per snapshot (partial count per task, then merge)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(alias))


def snapshot_gate(incoming: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Snapshot keys of ``incoming`` that ``existing`` does not hold yet.

    Both sides are de-duplicated map-side first; how they are joined is left to their measured
    sizes. A pipeline gates on folder names instead (``plans.pipeline``)."""
    return incoming.select(key).distinct().join(existing.select(key).distinct(), on=key, how="left_anti")


def history_union(frames: Sequence[DataFrame]) -> DataFrame:
    """All snapshots as one table; columns matched by name, missing ones null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def rekey_plan(files: DataFrame, file_col: str = "file", target_col: str = "target", action_col: str = "action") -> DataFrame:
    """Re-key snapshot files by their own snapshot date and drop duplicates.

    Input: one row per file with its target name (null when the file has no date).
    Per target the keeper is the file already named right, else the first file by name;
    it is renamed, every other file with the same target is deleted, files without a date
    are left alone. The keeper per target is an aggregate (``min`` of a struct, partial per
    task), joined back on the target.
    """
    f, t = F.col(file_col), F.col(target_col)
    # files without a target can never share one: they take no part in the join
    dated, undated = files.where(t.isNotNull()), files.where(t.isNull())
    keepers = dated.groupBy(target_col).agg(
        F.min(F.struct((f != t).alias("misnamed"), f.alias("name"))).getField("name").alias("_keeper")
    )
    plan = dated.join(keepers, on=target_col, how="left")
    action = F.when(f == t, F.lit("SKIP")).when(f == F.col("_keeper"), F.lit("RENAME")).otherwise(F.lit("DELETE"))
    return plan.select(f, t, action.alias(action_col)).union(undated.select(f, t, F.lit("SKIP").alias(action_col)))


def rekeyed(records: DataFrame, plan: DataFrame, file_col: str = "file", action_col: str = "action", target_col: str = "target") -> DataFrame:
    """W1, the kept data: the records of files that are not dropped, with their file renamed."""
    kept = plan.where(F.col(action_col) != "DELETE")
    name = F.when(F.col(action_col) == "RENAME", F.col(target_col)).otherwise(F.col(file_col))
    names = kept.select(F.col(file_col).alias("_old"), name.alias("_new"))
    out = records.join(names, F.col(file_col) == F.col("_old"))
    return out.select(*(F.col("_new").alias(c) if c == file_col else F.col(c) for c in records.columns))


def file_targets(records: DataFrame, file_col: str, order_col: str, date_text_col: str, prefix: str = "", suffix: str = "") -> DataFrame:
    """W1 input: the target of each file from its *first* record's date text."""
    first = records.groupBy(file_col).agg(F.min_by(F.col(date_text_col), F.col(order_col)).alias("_d"))
    target = F.when(
        F.col("_d").isNull() | (F.col("_d") == ""), F.lit(None).cast("string")
    ).otherwise(F.concat(F.lit(prefix), snapshot_key("_d"), F.lit(suffix)))
    return first.select(F.col(file_col).alias("file"), target.alias("target"))


def history_metrics(df: DataFrame, key: str, entity: str) -> DataFrame:
    """Per snapshot, entities present, new (absent from the previous snapshot) and
    gone (present in the previous snapshot, absent now).

    Rows are first reduced to distinct (entity, snapshot) pairs, so the per-entity window holds at
    most one row per snapshot however many rows an entity has. A pair knows the entity's previous
    and next snapshot; the snapshots' own neighbours come from the one-row-per-snapshot totals, so
    the pairs are read once."""
    pairs = df.select(F.col(entity).alias("_e"), F.col(key).alias("_k")).where(F.col("_k").isNotNull()).distinct()
    w = Window.partitionBy("_e").orderBy("_k")
    near = pairs.select("_k", F.lag("_k").over(w).alias("_before"), F.lead("_k").over(w).alias("_after"))
    # how many pairs of a snapshot come from which previous, and go to which next snapshot: at most
    # one row per pair of snapshots
    steps = near.groupBy("_k", "_before", "_after").agg(F.count(F.lit(1)).alias("n"))
    seq = Window.orderBy("_k")  # one row per snapshot
    keys = steps.select("_k").distinct().select("_k", F.lag("_k").over(seq).alias("_last"), F.lead("_k").over(seq).alias("_next"))
    known = steps.join(keys, "_k")
    new = ~F.coalesce(F.col("_before") == F.col("_last"), F.lit(False))
    left = ~F.coalesce(F.col("_after") == F.col("_next"), F.lit(False))
    part = lambda test: F.sum(F.when(test, F.col("n")).otherwise(F.lit(0))).cast("long")
    totals = known.groupBy("_k").agg(F.sum("n").alias("present"), part(new).alias("new"), part(left).alias("_left"))
    gone = F.coalesce(F.lag("_left").over(seq), F.lit(0)).cast("long")
    return totals.select(F.col("_k").alias(key), "present", "new", gone.alias("gone"))


def days_open(df: DataFrame, key: str, entity: str) -> DataFrame:
    """Per entity its first and last snapshot, the number of snapshots that hold it, and the
    days between the first and the last, both counted (a partial aggregate; distinct snapshots
    only, so an entity with many rows is no heavier)."""
    pairs = df.select(entity, key).where(F.col(key).isNotNull()).distinct()
    span = pairs.groupBy(entity).agg(F.min(key).alias("first_seen"), F.max(key).alias("last_seen"), F.count(F.lit(1)).alias("snapshots"))
    return span.withColumn("days_open", (F.date_diff("last_seen", "first_seen") + 1).cast("long"))
