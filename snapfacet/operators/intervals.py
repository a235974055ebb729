"""Change history as validity intervals: E3 on a stored table that one snapshot at a time is merged into.

A row says that an entity (a job) had one content from snapshot ``first_seen`` to snapshot ``last_seen``, in every
snapshot between. ``valid_from`` is the first of them and ``valid_to`` the snapshot after the last one, in which
the content was gone (null: it is in the newest). A job whose content changes has one interval ending where the next
begins.

Adding a snapshot s between its neighbours p and n (either may be missing) touches intervals that end at p, begin at n or go over
both, and no others:

* present in s: joined to what ends at p and begins at n, or a new interval;
* absent from s: an interval over p and n is cut in two.

So the table does not depend on the order in which snapshots come, and adding one again replaces what it said. The rows are
kept in partitions by ``last_seen``; for the newest snapshot those of the one before are read and written, for a late one those from
there on. Closed history stays as it is. The new partitions are published together (``sources.versions``).

The merge is one grouping by (entity, content) of the snapshot's distinct pairs and the intervals touched, at most three rows a
key, however many rows the snapshot has of it. ``changes`` sums begins and ends per entity and snapshot before it
looks along an entity.

Defined results: a null content is a content; a null entity has intervals, but no changes (it cannot be followed);
repeated rows are one; an empty snapshot ends every interval.
"""

from __future__ import annotations

import json
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources import versions as V

FIRST, LAST = "first_seen", "last_seen"


class IntervalTable:
    """The interval table under ``path``. Snapshot keys are texts whose order is that of time."""

    def __init__(self, spark: SparkSession, path: str, entity: str = "job_id", content: str = "content_id"):
        self.spark, self.path, self.entity, self.content = spark, path.rstrip("/"), entity, content

    def snapshots(self) -> list[str]:
        """The snapshots added so far, in order."""
        version = V.current(self.spark, self.path)
        return json.loads(version.note)["snapshots"] if version else []

    def _stored(self, schema: str, after: str | None = None) -> tuple[DataFrame, tuple]:
        """The intervals of the partitions from ``after`` on, and the folders of the others."""
        version = V.current(self.spark, self.path)
        folders = version.folders if version else ()
        mine = tuple(f for f in folders if after is None or f[0] >= after)
        rest = tuple(f for f in folders if f not in mine)
        if not mine:
            return self.spark.createDataFrame([], schema), rest
        return V.read(self.spark, self.path, replace(version, folders=mine), schema).select(self.entity, self.content, FIRST, LAST), rest

    def add(self, rows: DataFrame, snapshot: str) -> None:
        """Merge the whole snapshot ``rows``; one that was added before is replaced."""
        known = self.snapshots()
        before = max((k for k in known if k < snapshot), default=None)
        after = min((k for k in known if k > snapshot), default=None)
        kinds = [f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in (self.entity, self.content)]
        # of a snapshot that is known, its own partition is rewritten too
        stored, rest = self._stored(", ".join([*kinds, f"{FIRST} string", f"{LAST} string"]), before)
        merged = _merged(stored, rows.select(self.entity, self.content), self.entity, self.content, before, snapshot, after)
        id_, folders = V.write(self.spark, self.path, merged, LAST)
        note = json.dumps({"snapshots": sorted({*known, snapshot})})
        V.publish(self.spark, self.path, id_, tuple(sorted([*folders, *rest])), LAST, note=note)

    def intervals(self) -> DataFrame:
        """All intervals: entity, content, first_seen, last_seen, valid_from, valid_to."""
        known = self.snapshots()
        version = V.current(self.spark, self.path)
        if version is None:
            raise ValueError(f"{self.path}: no snapshot was added yet")
        schema = None
        if not version.folders:
            raise ValueError(f"{self.path}: no snapshot had any rows")
        stored = V.read(self.spark, self.path, version, schema).select(self.entity, self.content, FIRST, LAST)
        return stored.withColumn("valid_from", F.col(FIRST)).withColumn("valid_to", _next(F.col(LAST), known))

    def as_of(self, snapshot: str) -> DataFrame:
        """(entity, content) of a snapshot: partitions that ended before it are not read."""
        held = self.intervals().where((F.col(FIRST) <= F.lit(snapshot)) & (F.col(LAST) >= F.lit(snapshot)))
        return held.select(self.entity, self.content)

    def changes(self) -> DataFrame:
        """(snapshot, entity, change, contents): for each snapshot after the first, the entities that are 'new', 'reopened'
        (were there before, but not in the last snapshot), 'changed' or 'closed' in it; ``contents`` is how many they have now."""
        known = self.snapshots()
        held = self.intervals().where(F.col(self.entity).isNotNull())
        one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
        begins = held.select(self.entity, F.col("valid_from").alias("snapshot"), one.alias("begun"), none.alias("ended"))
        ends = held.where("valid_to IS NOT NULL").select(self.entity, F.col("valid_to").alias("snapshot"), none.alias("begun"), one.alias("ended"))
        steps = begins.union(ends).groupBy(self.entity, "snapshot").agg(F.sum("begun").alias("begun"), F.sum("ended").alias("ended"))
        # at most one row for each snapshot of an entity
        along = Window.partitionBy(self.entity).orderBy("snapshot")
        held_now = F.sum(F.col("begun") - F.col("ended")).over(along.rowsBetween(Window.unboundedPreceding, 0))
        steps = steps.withColumn("contents", held_now).withColumn("was", F.col("contents") - F.col("begun") + F.col("ended"))
        steps = steps.withColumn("nth", F.row_number().over(along))
        change = (
            F.when(F.col("contents") == 0, "closed")
            .when((F.col("was") == 0) & (F.col("nth") == 1), "new")
            .when(F.col("was") == 0, "reopened")
            .otherwise("changed")
        )
        out = steps.select("snapshot", self.entity, change.alias("change"), "contents")
        return out.where(F.col("snapshot") > F.lit(known[0]))


def _next(key: Column, known: list[str]) -> Column:
    """The snapshot after a key (null: it is the last)."""
    pairs = [F.lit(x) for kv in zip(known, known[1:]) for x in kv]
    return F.try_element_at(F.create_map(*pairs), key) if pairs else F.lit(None).cast("string")


def _merged(stored: DataFrame, rows: DataFrame, entity: str, content: str, before: str | None, snapshot: str, after: str | None) -> DataFrame:
    """The touched and untouched intervals of ``stored`` with the snapshot merged in."""
    p, s, n = (F.lit(k).cast("string") for k in (before, snapshot, after))
    first, last = F.col(FIRST), F.col(LAST)
    # what the table says without the snapshot: an interval that begins or ends with it loses it
    cut = stored.withColumn(FIRST, F.when(first == s, F.when(last == s, F.lit(None)).otherwise(n)).otherwise(first))
    cut = cut.where(first.isNotNull()).withColumn(LAST, F.when(last == s, p).otherwise(last))
    ends, begins, over = (F.coalesce(c, F.lit(False)) for c in (last == p, first == n, (first <= p) & (last >= n)))
    kind = F.when(over, "over").when(ends, "ends").when(begins, "begins")
    cut = cut.withColumn("_kind", kind)
    there = rows.distinct().select(entity, content, F.lit(None).cast("string").alias(FIRST), F.lit(None).cast("string").alias(LAST), F.lit("there").alias("_kind"))
    touched = cut.where("_kind IS NOT NULL").unionByName(there).groupBy(entity, content)
    of = lambda k, c: F.max(F.when(F.col("_kind") == k, F.col(c)))
    per_key = touched.agg(
        F.max(F.col("_kind") == "there").alias("there"),
        of("over", FIRST).alias("of"),
        of("over", LAST).alias("ol"),
        of("ends", FIRST).alias("ef"),
        of("begins", LAST).alias("bl"),
    )
    span = lambda a, b: F.struct(a.alias(FIRST), b.alias(LAST))
    c = F.col
    present = F.when(c("of").isNotNull(), F.array(span(c("of"), c("ol")))).otherwise(F.array(span(F.coalesce("ef", s), F.coalesce("bl", s))))
    absent = F.filter(
        F.array(
            F.when(c("of").isNotNull(), span(c("of"), p)),
            F.when(c("of").isNotNull(), span(n, c("ol"))),
            F.when(c("ef").isNotNull(), span(c("ef"), p)),
            F.when(c("bl").isNotNull(), span(n, c("bl"))),
        ),
        lambda x: x.isNotNull(),
    )
    spans = per_key.select(entity, content, F.explode(F.when(c("there"), present).otherwise(absent)).alias("_span"))
    out = spans.select(entity, content, f"_span.{FIRST}", f"_span.{LAST}")
    return out.unionByName(cut.where("_kind IS NULL").drop("_kind"))
