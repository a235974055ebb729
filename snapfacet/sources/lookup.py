"""Stored tables that are looked up by id (F13): Parquet with bloom filters on the id columns.

Ids are hashes: every row group's smallest and largest id are about the same, so statistics skip nothing, and a
lookup would read the id column of the whole table. A bloom filter per row group, written beside the data, says of nearly all row
groups that they do not hold the id; they are passed over without reading a page. The filters' size
adapts to the number of distinct ids in a row group (about a byte and a half each at one false positive in a hundred).

A lookup of up to ``LISTED`` ids goes into the scan as equality tests, which row groups are tested by; more ids, or a frame of
ids, are a semi join, which has to read the id column anyway.

Defined results: an id that is nowhere gives no row; a null id finds nothing; repeated ids in the list, or rows in the
table, are not multiplied by each other: each row with one of the ids comes once.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Ids that are tested one by one in the scan.
LISTED = 256
FALSE_POSITIVES = 0.01


def bloom_options(id_cols: Sequence[str], most_bytes: int = 1 << 20) -> dict[str, str]:
    """Writer options for bloom filters on the given columns of each row group."""
    out = {"parquet.bloom.filter.adaptive.enabled": "true", "parquet.bloom.filter.max.bytes": str(most_bytes)}
    for c in id_cols:
        out[f"parquet.bloom.filter.enabled#{c}"] = "true"
        out[f"parquet.bloom.filter.fpp#{c}"] = str(FALSE_POSITIVES)
    return out


def write_for_lookup(df: DataFrame, path: str, id_cols: Sequence[str] = ("id",), partition_by: Sequence[str] = (), mode: str = "error", **options) -> None:
    """Write a table that ``lookup`` reads few row groups of."""
    missing = [c for c in id_cols if c not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {missing}")
    writer = df.write.mode(mode).option("compression", "zstd").options(**bloom_options(id_cols), **options)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def lookup(df: DataFrame, ids: Iterable | DataFrame, id_col: str = "id") -> DataFrame:
    """F13 on a stored table: its rows with one of the ids (values, or a frame with the column ``id_col``)."""
    if isinstance(ids, DataFrame):
        return df.join(ids.select(id_col).distinct(), id_col, "left_semi")
    values = [v for v in dict.fromkeys(ids) if v is not None]
    if not values:
        return df.limit(0)
    if len(values) > LISTED:
        kind = df.schema[id_col].dataType.simpleString()
        return df.join(df.sparkSession.createDataFrame([(v,) for v in values], f"`{id_col}` {kind}"), id_col, "left_semi")
    # one by one: a list of more than ten values would reach the scan as a range, which every row group spans
    return df.where(reduce(lambda a, b: a | b, (F.col(id_col) == F.lit(v) for v in values)))


def read_for_lookup(spark: SparkSession, path: str, ids: Iterable | DataFrame, id_col: str = "id") -> DataFrame:
    return lookup(spark.read.parquet(path), ids, id_col)
