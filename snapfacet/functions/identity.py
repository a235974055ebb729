"""Row identity.

``row_hash`` is md5 over a canonical text of the chosen columns: values as text, a
sentinel for null (``concat_ws`` would otherwise skip nulls, and ``(a, null)`` would equal
``(null, a)``), a unit separator between fields, arrays joined with their own separator.
``id`` hashes all columns (so one posting has another id in every snapshot, as in the
reference); ``content_id`` leaves out the snapshot date and so follows a posting across
snapshots.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import col

FIELD_SEP = "\u001f"
ITEM_SEP = "\u001e"
NULL_TOKEN = "\u0001"


def _as_text(df: DataFrame | None, name: str) -> Column:
    c = F.col(name)
    dtype = df.schema[name].dataType if df is not None else None
    if isinstance(dtype, T.ArrayType):
        return F.array_join(c, ITEM_SEP, NULL_TOKEN)
    if isinstance(dtype, T.StringType):
        return c
    return c.cast("string")


def row_hash(columns: Sequence[str], df: DataFrame | None = None) -> Column:
    parts = [F.coalesce(_as_text(df, c), F.lit(NULL_TOKEN)) for c in columns]
    return F.md5(F.concat_ws(FIELD_SEP, *parts))


def with_row_ids(
    df: DataFrame,
    id_col: str = "id",
    content_col: str | None = "content_id",
    snapshot_cols: Sequence[str] = ("processed_date",),
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Add ``id`` (all columns) and optionally ``content_id`` (without the snapshot
    columns) as the first columns."""
    cols = [c for c in (columns or df.columns) if c not in (id_col, content_col)]
    out = [row_hash(cols, df).alias(id_col)]
    if content_col:
        content = [c for c in cols if c not in snapshot_cols]
        out.append(row_hash(content, df).alias(content_col))
    return df.select(*out, *[col(c) for c in df.columns if c not in (id_col, content_col)])


def lookup_one(df: DataFrame, id_col: str, value) -> DataFrame:
    """point lookup -> one row or none."""
    return df.where(F.col(id_col) == (value if isinstance(value, Column) else F.lit(value))).limit(1)


def lookup_many(df: DataFrame, id_col: str, keys: DataFrame, key_col: str | None = None) -> DataFrame:
    """F13 batch form: rows whose id is in a frame of keys (left semi join; the planner
    broadcasts the keys when their measured size allows, else sort-merges). The keys are
    de-duplicated first -- a partial aggregate inside every task -- so a key repeated in a
    third of the key rows reaches the join as one row per task, not as one huge group."""
    k = keys.select(F.col(key_col or id_col).alias(id_col)).distinct()
    return df.join(k, on=id_col, how="left_semi")
