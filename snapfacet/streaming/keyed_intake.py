"""R1 with keyed state: files are read once, when they are new, also those that come late.

``intake`` rewrites a snapshot whole when a file of it arrives, and reads all landed files of it for that. Here the stream itself knows what it
has taken in: a stateful operator holds a key for each record (its snapshot, and a hash of the chosen columns), so a record that is landed
again, in the same file name or another, is dropped, and each micro-batch appends only what is new. A file that comes days later for an old
snapshot adds its records to that snapshot; nothing else is read or written.

State is bounded by the watermark: the event time is the snapshot's time, and keys of snapshots more than ``keep`` before the newest one are
forgotten. A record of a snapshot that is older than that when it arrives is too late: it is dropped, and counted in the query's
progress (``numRowsDroppedByWatermark``). The default keeps ten years.

Every micro-batch is written to folders of its own (``<key>=<value>/batch=<epoch>``) by dynamic partition overwrite: a batch that is run again
after a failure replaces its own folders and no others, so each record is stored once. State, offsets and output are in the shared folder.

Defined results: records that are equal in the chosen columns are one record of their snapshot; a snapshot without a time (its key is no date)
is never forgotten, but only until the watermark moves are its records taken: such keys are refused; an empty landing folder gives no batch.
"""

from __future__ import annotations

import uuid
from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir
from .intake import land

KEEP = "3650 days"
BATCH = "batch"


def keyed_intake(
    spark: SparkSession,
    landing: str,
    output: str,
    checkpoint: str,
    schema: T.StructType,
    key: str,
    identity: Sequence[str] | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    keep: str = KEEP,
    max_files_per_trigger: int | None = None,
) -> dict:
    """Take in everything landed so far. ``key`` is the snapshot column (a date, or a text that casts to a timestamp), ``identity`` the columns that
    make a record (None: all). Returns the rows read, new and too late, over all micro-batches."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = reader.json(landing)
    columns = list(identity or rows.columns)
    # fields with their length in front: no two records have one text
    text = lambda c: F.coalesce(F.concat(F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-"))
    rows = rows.withColumn("_record", F.sha2(F.concat(*(text(c) for c in columns)), 256))
    rows = rows.withColumn("_time", F.col(key).cast("timestamp"))
    fresh = rows.withWatermark("_time", keep).dropDuplicates(["_time", "_record"])
    done = {"read": 0, "new": 0, "late": 0}

    def write_batch(batch: DataFrame, epoch: int) -> None:
        out = batch.drop("_record", "_time")
        out = (transform(out) if transform else out).withColumn(BATCH, F.lit(epoch))
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(key, BATCH).parquet(output)

    query = fresh.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    for p in query.recentProgress:
        done["read"] += p["numInputRows"]
        for s in p["stateOperators"]:
            done["new"] += s["numRowsUpdated"]
            done["late"] += s["numRowsDroppedByWatermark"]
    return done


def taken_in(spark: SparkSession, output: str) -> DataFrame:
    """The records taken in, without the batch that brought them."""
    return spark.read.parquet(output).drop(BATCH)


def run_keyed_intake(spark: SparkSession, landings: Sequence[tuple[DataFrame, bool]], key: str) -> tuple[DataFrame, list[dict]]:
    """Land each frame in a fresh area under the shared checkpoint folder (as further files of its snapshots, or in place of
    them) and take it in. Returns the records taken in, and what each run has read and added."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/snapfacet-keyed-{uuid.uuid4().hex}"
    landing, output, checkpoint = f"{base}/landing", f"{base}/out", f"{base}/checkpoint"
    first = landings[0][0]
    schema = T.StructType([T.StructField(f.name, T.StringType(), True) for f in first.schema if f.name != key] + [first.schema[key]])
    runs = []
    for frame, append in landings:
        land(frame, landing, key, append=append)
        runs.append(keyed_intake(spark, landing, output, checkpoint, schema, key))
    return taken_in(spark, output), runs
