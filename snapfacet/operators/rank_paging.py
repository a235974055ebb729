"""Any page of an ordered result by rank selection: T4 without sorting, or keeping, the rows before it.

``search.page`` keeps ``offset + limit`` rows in every task; in the middle of a large result that is half of it. Here the
rows that a page consists of are found first:

1. splitters of the sort key are taken from a small set of its values, chosen by hash (they only decide where the ranges
   lie, never which rows are returned);
2. the rows in each range between splitters are counted, exactly, in one scan of the key;
3. the ranges that hold the page are kept, and the rows before them are taken off the offset.

This is repeated within a range that still holds more than ``most`` rows, and by the next key of the order where a
range is one value of the key: a value that a third of all rows have is split by the tie-break. Then the rows of those ranges are sorted
as any page is, with at most ``most + limit`` rows in a task. Each round reads the keys of the range only, and the filters
reach the scan. At most ``WAYS`` splitters and counts come to the driver.

Defined results: those of ``search.page`` (nulls last both ways); a page after the end is empty.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .search import order_columns

WAYS, MOST = 256, 100_000


def _splitters(df: DataFrame, key: str, ways: int) -> list:
    """Up to ``ways`` values of the key, in order: those of the smallest hashes, each once."""
    some = df.select(key).where(F.col(key).isNotNull()).distinct().orderBy(F.xxhash64(key), key).limit(ways)
    return [v for v in (r[0] for r in some.orderBy(key).collect()) if v == v]  # NaN is no splitter


def _range_of(key: Column, cuts: list, first: int = 0) -> Column:
    """The number of cuts that are at or below the key, by a balanced tree of comparisons. Cuts are in order."""
    if not cuts:
        return F.lit(first)
    mid = len(cuts) // 2
    return F.when(key < F.lit(cuts[mid]), _range_of(key, cuts[:mid], first)).otherwise(_range_of(key, cuts[mid + 1 :], first + mid + 1))


def _between(key: Column, cuts: list, number: int | None, floating: bool) -> Column:
    """Rows of one range (None: the nulls; the one after the last: NaN)."""
    if number is None:
        return key.isNull()
    if number > len(cuts):
        return F.isnan(key)
    tests = [key.isNotNull()]
    if floating and number == len(cuts):
        tests.append(~F.isnan(key))
    if number > 0:
        tests.append(key >= F.lit(cuts[number - 1]))
    if number < len(cuts):
        tests.append(key < F.lit(cuts[number]))
    return reduce(lambda a, b: a & b, tests)


def _pieces(df: DataFrame, keys: Sequence[str], descending: bool, offset: int, limit: int, most: int, rows: int | None) -> list:
    """(rows, offset, limit) of the parts of ``df`` that the page consists of, each small enough to be sorted."""
    if limit <= 0 or (rows is not None and (rows <= most or not keys)) or not keys:
        return [(df, offset, limit)]
    key, cuts = F.col(keys[0]), _splitters(df, keys[0], WAYS)
    floating = df.schema[keys[0]].dataType.typeName() in ("double", "float")
    number = _range_of(key, cuts)
    if floating:  # NaN is a range of its own: it is no bound that a scan can be pruned by
        number = F.when(F.isnan(key), F.lit(len(cuts) + 1)).otherwise(number)
    number = F.when(key.isNull(), F.lit(None).cast("int")).otherwise(number)
    counts = {r["n"]: r["rows"] for r in df.groupBy(number.alias("n")).agg(F.count(F.lit(1)).alias("rows")).collect()}
    order = sorted((n for n in counts if n is not None), reverse=descending) + [n for n in counts if n is None]
    out, before = [], 0
    for n in order:
        held = counts[n]
        first, end = max(offset, before), min(offset + limit, before + held)
        skip, take, before = first - before, end - first, before + held
        if take <= 0:
            continue
        part = df.where(_between(key, cuts, n, floating))
        if held <= most:
            out.append((part, skip, take))
        elif n is not None and n <= len(cuts) and not _one_value(part, keys[0]):
            out += _pieces(part, keys, descending, skip, take, most, held)
        else:  # one value, NaN, or nulls: the next key decides; the further keys of an order ascend
            out += _pieces(part, keys[1:], False, skip, take, most, held)
    return out


def _one_value(part: DataFrame, key: str) -> bool:
    ends = part.agg(F.min(key).alias("a"), F.max(key).alias("b")).select(F.col("a").eqNullSafe(F.col("b")).alias("one")).first()
    return bool(ends["one"])


def rank_page(
    df: DataFrame,
    predicate: Column | None,
    order_by: str,
    descending: bool = True,
    limit: int = 25,
    offset: int = 0,
    tiebreak: Sequence[str] = (),
    most: int = MOST,
) -> DataFrame:
    """T4: the page that ``search.page`` gives for the same arguments, wherever it lies."""
    rows = df if predicate is None else df.where(predicate)
    order = order_columns(order_by, descending, tiebreak)
    parts = [p for p in _pieces(rows, [order_by, *tiebreak], descending, offset, limit, most, None) if p[2] > 0]
    if not parts:
        return rows.limit(0)

    def piece(part: DataFrame, skip: int, take: int) -> DataFrame:
        out = part.orderBy(*order)
        return (out.offset(skip) if skip else out).limit(take)

    found = reduce(lambda a, b: a.unionByName(b), (piece(*p) for p in parts))
    return found.orderBy(*order).limit(limit) if len(parts) > 1 else found
