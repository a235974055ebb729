"""Row numbering of a sorted frame without a single-partition window.

``Window.orderBy`` without ``partitionBy`` moves every row into one task. Here the frame is sorted by range
partitions and written to the shared scratch folder with each row's partition and its place in it
(``monotonically_increasing_id`` holds both); the rows of each partition are counted, and a row's number is
its place plus the rows of all partitions before. One number per partition comes to the driver; no row
goes through Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch

#: ``monotonically_increasing_id`` keeps the partition above, and the place below this bit.
_PLACE_BITS = 33


def number_rows(df: DataFrame, order: list[Column], name: str = "position", start: int = 1) -> DataFrame:
    """Sort by ``order`` and add a 1-based (by default) position column."""
    path = scratch(df.sparkSession, "numbered")
    df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()).write.parquet(path)
    stored = df.sparkSession.read.parquet(path)
    part = F.shiftrightunsigned("_place", _PLACE_BITS)
    sizes = sorted((r["p"], r["n"]) for r in stored.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
    before, pairs = start, []
    for p, n in sizes:
        pairs += [F.lit(p).cast("long"), F.lit(before).cast("long")]
        before += n
    offset = F.element_at(F.create_map(*pairs), part) if pairs else F.lit(start).cast("long")
    place = F.col("_place").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return stored.withColumn(name, offset + place).drop("_place").orderBy(name)
