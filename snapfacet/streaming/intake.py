"""Incremental snapshot intake as a file stream.

Raw snapshots land as JSON lines under ``landing/<key>=<value>/``. A file stream with
``trigger(availableNow=True)`` picks up only files it has not seen (the stream checkpoint
remembers them), and every micro-batch is written by ``foreachBatch``:

* the keys touched by the batch are found (a distinct over the batch; one value per snapshot),
* *all* landed rows of those keys are read back (a partition filter on the landing folder), so a
  snapshot whose files arrive over several batches is still written whole,
* they are transformed and written with dynamic partition overwrite.

Landing a snapshot replaces what was landed under its key, so landing it twice is the same as
landing it once; ``append=True`` adds a late file to it. Re-running with nothing new processes no
batch (the reference's "No new data"). The checkpoint and output folders live in the
shared folder named by ``spark.checkpoint.dir``, never in a machine-local directory.
"""

from __future__ import annotations

import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir


def intake(
    spark: SparkSession,
    landing: str,
    output: str,
    checkpoint: str,
    schema: T.StructType,
    key: str,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    max_files_per_trigger: int | None = None,
) -> int:
    """Run the stream until everything landed so far is written; returns the number of
    micro-batches that wrote data."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.json(landing)
    written = []

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        keys = [r[0] for r in batch.select(key).distinct().collect()]  # one per snapshot
        if not keys:
            return
        # whole snapshots of the touched keys, read back from the landing folder
        full = spark.read.schema(schema).json(landing).where(F.col(key).isin(keys))
        out = transform(full) if transform else full
        (
            out.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", "zstd")
            .partitionBy(key)
            .parquet(output)
        )
        written.append(epoch_id)

    q = (
        stream.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return len(written)


def land(df: DataFrame, landing: str, key: str, append: bool = False) -> None:
    """Land raw rows as JSON lines, one folder per snapshot key. A key that was landed before is
    replaced (landing is idempotent), unless ``append`` adds the rows as a late file."""
    writer = df.write.mode("append") if append else df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(key).json(landing)


def run_intake(spark: SparkSession, raw: DataFrame, key: str, times: int = 1) -> DataFrame:
    """Land ``raw`` ``times`` times in a fresh area under the shared checkpoint folder, run the
    intake after each landing and return the written table (ids back to numbers)."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/snapfacet-intake-{uuid.uuid4().hex}"
    landing, output, ckpt = f"{base}/landing", f"{base}/out", f"{base}/checkpoint"
    schema = T.StructType(
        [T.StructField(f.name, T.StringType() if f.name != key else f.dataType, True) for f in raw.schema.fields]
    )
    # partition column last, as Spark appends it when reading the landing folder
    schema = T.StructType([f for f in schema.fields if f.name != key] + [schema[key]])

    def typed(df: DataFrame) -> DataFrame:
        return df.select(
            F.col("event_id").cast("long").alias("event_id"),
            F.col("user_id").cast("long").alias("user_id"),
            "event_type",
            key,
        )

    for _ in range(times):
        land(raw, landing, key)
        intake(spark, landing, output, ckpt, schema, key, typed)
    return spark.read.parquet(output).select("event_id", "user_id", "event_type", key)
