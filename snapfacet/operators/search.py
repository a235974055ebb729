"""Search: page + total (G5), ordering and paging (T1-T4), count (A1), page count (A4).

A page is ``where -> orderBy -> offset -> limit``: Spark plans it as
``TakeOrderedAndProject`` -- every partition keeps its own best ``offset + limit`` rows and
only those reach the final merge, so no total sort of the table is ever done. The total is
a separate aggregate over the same predicate (partial count per partition, then a merge of
one number per partition). Nulls sort last in both directions and a unique key is always
appended, so pages never repeat or drop rows that share a sort value.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.common import ColumnOrName, col
from .block_search import DIGITS, BlockIndex
from .predicates import SearchSpec
from .text_index import scored_rows


def order_columns(key: ColumnOrName, descending: bool, tiebreak: Sequence[str] = ()) -> list[Column]:
    """Nulls last both ways, then the tie-break keys ascending."""
    k = col(key)
    first = k.desc_nulls_last() if descending else k.asc_nulls_last()
    return [first] + [col(t).asc_nulls_last() for t in tiebreak]


def page(
    df: DataFrame,
    predicate: Column | None,
    order_by: ColumnOrName,
    descending: bool = True,
    limit: int = 25,
    offset: int = 0,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """One page of the filtered rows."""
    out = df if predicate is None else df.where(predicate)
    out = out.orderBy(*order_columns(order_by, descending, tiebreak))
    if offset:
        out = out.offset(int(offset))
    return out.limit(int(limit))


def last_page(
    df: DataFrame,
    predicate: Column | None,
    order_by: ColumnOrName,
    descending: bool = True,
    page_size: int = 25,
    total_rows: int | None = None,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """T4 "last" button: the final page, read from the other end of the order.

    Offset paging keeps ``offset + limit`` rows per task for the top-k merge, so the last
    page of a huge result would be the most expensive one. Reversing every sort key (and
    where nulls go) turns it into a first page of ``rows_on_last_page`` rows; those few rows
    are then put back in the requested order. ``total_rows`` is the request's total (A1)."""
    out = df if predicate is None else df.where(predicate)
    if total_rows is None:
        total_rows = out.count()
    if total_rows <= 0:
        return out.limit(0)
    rows_on_last = total_rows - (math.ceil(total_rows / page_size) - 1) * page_size
    k = col(order_by)
    backwards = [k.asc_nulls_first() if descending else k.desc_nulls_first()] + [col(t).desc_nulls_first() for t in tiebreak]
    return out.orderBy(*backwards).limit(int(rows_on_last)).orderBy(*order_columns(order_by, descending, tiebreak))


def total(df: DataFrame, predicate: Column | None, alias: str = "total") -> DataFrame:
    """A1: number of rows under the same predicate as the page (one row)."""
    out = df if predicate is None else df.where(predicate)
    return out.agg(F.count(F.lit(1)).alias(alias))


def page_count(total_df: DataFrame, page_size: int = 25, total_col: str = "total", alias: str = "pages") -> DataFrame:
    """A4: ``ceil(total / size)`` next to the total."""
    return total_df.select(
        F.col(total_col),
        F.ceil(F.col(total_col) / F.lit(float(page_size))).cast("long").alias(alias),
    )


def keyset_page(
    df: DataFrame,
    predicate: Column | None,
    key: str,
    unique: str,
    after_key,
    after_unique,
    descending: bool = True,
    limit: int = 25,
) -> DataFrame:
    """T4: the page after a known last row (key value, unique value).

    Order is ``key`` (desc or asc, nulls last) then ``unique`` ascending. Deep pages cost the
    same as the first one: no offset rows are read and thrown away. ``after_key=None`` means
    the previous page ended inside the null tail of the key.
    """
    k, u = F.col(key), F.col(unique)
    if after_key is None:
        cond = k.isNull() & (u > F.lit(after_unique))
    else:
        beyond = (k < F.lit(after_key)) if descending else (k > F.lit(after_key))
        cond = beyond | ((k == F.lit(after_key)) & (u > F.lit(after_unique))) | k.isNull()
    pred = cond if predicate is None else (predicate & cond)
    return page(df, pred, key, descending, limit, 0, (unique,))


@dataclass
class SearchResult:
    """G5 result: a lazy page and a lazy one-row total."""

    page: DataFrame
    total: DataFrame

    def collect(self):
        rows = self.page.collect()
        n = self.total.first()[0]
        return rows, n

    @staticmethod
    def pages(n_total: int, size: int) -> int:
        return math.ceil(n_total / size) if size else 0


def search(df: DataFrame, spec: SearchSpec, index=None, id_col: str = "id", substrings=None) -> SearchResult:
    """A request over a table -> page + total.

    Text search with ``text_mode='bm25'`` needs a stored index (see ``text_index``); with
    ``auto`` the index is used when one is given, otherwise the substring filter (X7). A block index
    (``block_search``) gives the page of a request without other filters from few of its blocks; scores are then rounded as it
    rounds them. ``substrings``, a trigram index of the table, stands for ``df`` in substring searches: the rows
    that cannot hold the term are not read.
    """
    mode = spec.text_mode
    if spec.text and mode == "auto":
        mode = "bm25" if index is not None else "literal"
        spec = spec.with_(text_mode=mode)
    if spec.text and mode == "bm25":
        if index is None:
            spec = spec.with_(text_mode="literal")
        else:
            pred = spec.predicate(include_text=False)
            if isinstance(index, BlockIndex):
                every = index.scores(spec.text).withColumnRenamed(index.id_col, id_col)
                scored = df.join(every.withColumn("score", F.round("score", DIGITS)), id_col)
                if spec.is_open():
                    best = index.top(spec.text, spec.limit, spec.offset).withColumnRenamed(index.id_col, id_col)
                    return SearchResult(page(df.join(best, id_col), None, "score", True, spec.limit, 0, (id_col,)), total(scored, None))
            else:
                scored = scored_rows(df, index, spec.text, id_col=id_col)
            return SearchResult(
                page=page(scored, pred, "score", True, spec.limit, spec.offset, (id_col,)),
                total=total(scored, pred),
            )
    if spec.text and substrings is not None:
        df = substrings.matching(spec.text, spec.text_mode, spec.text_columns)
        spec = spec.with_(text=None)
    pred = spec.predicate()
    tiebreak = (spec.tiebreak,) if spec.tiebreak and spec.tiebreak in df.columns else ()
    order = spec.order_by or (df.columns[0])
    return SearchResult(
        page=page(df, pred, order, spec.descending, spec.limit, spec.offset, tiebreak),
        total=total(df, pred),
    )
