"""Substring search by a stored trigram index: F1 without reading every text.

A text that holds a term holds all trigrams (runs of three characters) of the term. The index stores
the table with a row number, and for each trigram of the lower-cased search columns the numbers of the
rows that hold it. A search

1. looks up how many rows hold each trigram of the term, and takes the ``RAREST`` of them (one that no row
   holds: nothing is found);
2. intersects their row lists;
3. verifies the rows left with the very predicate of the scan (``predicates.substring_any``), so that the
   result is the scan's, row for row.

Terms, or with wildcards pieces of terms, of fewer than three characters have no trigram: they take the scan.

Building: a task takes the trigrams of its own texts, some million characters at a time, and hands on one list for each
(trigram, part) of them; what is shuffled and grouped are these lists, not a row for each trigram of each text.

Layout (Parquet):

* ``rows``: all columns of the table and ``row``, a number that is fixed by the write. Rows are numbered
  file by file, so the rows found are ranges of the files; the ranges go into the scan as filters.
* ``lists(gram, part, n, rows)``: a part is ``PART`` consecutive row numbers, so no list is longer than that, and a
  trigram that a third of all rows hold is spread over all parts. Lists of one part meet without the others:
  an intersection is a group per part of at most ``RAREST`` lists. Written by (gram, part) and sorted.
* ``grams(gram, n)``: number of rows that hold the trigram, in the order of the trigrams.

Defined results: those of the scan. Null texts hold nothing; null and repeated ids are rows like any other; an empty term
is in every text that is not null; case is folded as Spark's ``lower`` does it, accents count.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from typing import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch, ship_package
from .predicates import substring_any

#: Rows of a part (a power of two), trigrams of a term that are intersected, ranges in a scan's filter.
PART_BITS, RAREST, RANGES = 12, 4, 32
#: At most so many rows found are listed on the driver for the scan's filter; more are joined only.
LISTED = 10_000
#: Characters whose trigrams are sorted at a time: some 150 MB of a task's memory.
CHARS = 4_000_000


def _as_strings(codes: np.ndarray) -> pa.Array:
    """Strings of three characters from their code points (n x 3)."""
    sizes = 1 + (codes > 0x7F).astype(np.int32) + (codes > 0x7FF) + (codes > 0xFFFF)
    offsets = np.concatenate([[0], np.cumsum(sizes.sum(axis=1))]).astype(np.int32)
    text = codes.astype("<u4").tobytes().decode("utf-32-le").encode()
    return pa.StringArray.from_buffers(len(codes), pa.py_buffer(offsets), pa.py_buffer(text))


def _lists(rows: np.ndarray, texts: list[tuple]) -> Iterator[pa.RecordBatch]:
    """(gram, part, rows): the trigrams of some rows' texts (a tuple of columns a row), each with the rows that hold it."""
    pieces = [t or "" for row in texts for t in row]
    points = np.frombuffer("".join(pieces).encode("utf-32-le"), "<u4")
    piece = np.repeat(np.arange(len(pieces)), np.fromiter(map(len, pieces), np.int64, len(pieces)))
    inside = np.flatnonzero(piece[:-2] == piece[2:])
    if not len(inside):
        return
    seen = np.zeros(int(points.max()) + 1, bool)
    seen[points] = True
    alphabet = np.flatnonzero(seen)
    size, many = len(alphabet), len(texts)
    if size**3 * many >= 1 << 63:  # a key below would not fit (one row's always does)
        half = many // 2
        yield from _lists(rows[:half], texts[:half])
        yield from _lists(rows[half:], texts[half:])
        return
    letter = (np.cumsum(seen) - 1)[points]
    gram = (letter[inside] * size + letter[inside + 1]) * size + letter[inside + 2]
    key = np.sort(gram * many + piece[inside] // len(texts[0]))
    key = key[np.concatenate([[True], key[1:] != key[:-1]])]
    gram, held = key // many, rows[key % many]
    part = held >> PART_BITS
    starts = np.flatnonzero(np.concatenate([[True], (gram[1:] != gram[:-1]) | (part[1:] != part[:-1])]))
    first = gram[starts]
    points = alphabet[np.stack([first // (size * size), first // size % size, first % size], axis=1)]
    lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(held)), pa.int32()), pa.array(held))
    yield pa.RecordBatch.from_arrays([_as_strings(points), pa.array(part[starts]), lists], ["gram", "part", "rows"])


def gram_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, part, rows) of batches of a row number and lower-cased texts."""
    for batch in batches:
        rows, *columns = batch.columns
        rows, texts = rows.to_numpy(), list(zip(*(c.to_pylist() for c in columns)))
        ends = np.cumsum([sum(len(t) for t in row if t) for row in texts])
        start = 0
        while start < len(texts):
            done = ends[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(ends, done + CHARS, "right")))
            yield from _lists(rows[start:end], texts[start:end])
            start = end


def term_trigrams(spark: SparkSession, term: str, mode: str = "literal") -> list[str]:
    """The trigrams that every match of a term holds, folded as the index folds them."""
    pieces = [term] if mode == "literal" else re.split("[%_]", term)
    row = spark.range(1).select(*(F.lower(F.lit(p)).alias(f"p{i}") for i, p in enumerate(pieces))).first()
    return sorted({p[i : i + 3] for p in row for i in range(len(p) - 2)})


@dataclass
class TrigramIndex:
    rows: DataFrame  # the table's columns, row
    lists: DataFrame  # gram, part, n, rows
    grams: DataFrame  # gram, n
    columns: tuple

    @staticmethod
    def load(spark: SparkSession, path: str) -> "TrigramIndex":
        columns = tuple(spark.read.parquet(f"{path}/columns").first()["columns"])
        return TrigramIndex(*(spark.read.parquet(f"{path}/{t}") for t in ("rows", "lists", "grams")), columns)

    def rarest(self, grams: list[str]) -> list[str] | None:
        """The trigrams to intersect; None where one of them is in no row."""
        known = self.grams.where(F.col("gram").isin(grams)).orderBy("n", "gram").collect()  # one row per trigram of the term
        return [r["gram"] for r in known[:RAREST]] if len(known) == len(grams) else None

    def candidates(self, term: str, mode: str = "literal") -> DataFrame | None:
        """(row) that hold the rarest trigrams of the term; None where it has no trigram."""
        spark = self.rows.sparkSession
        grams = term_trigrams(spark, term, mode)
        if not grams:
            return None
        chosen = self.rarest(grams)
        if chosen is None:
            return spark.createDataFrame([], "row long")
        held = self.lists.where(F.col("gram").isin(chosen)).groupBy("part").agg(F.collect_list("rows").alias("lists"))
        held = held.where(F.size("lists") == len(chosen))
        both = F.aggregate("lists", F.element_at("lists", 1), F.array_intersect)
        return held.select(both.alias("found")).where(F.size("found") > 0).select(F.explode("found").alias("row"))

    def matching(self, term: str, mode: str = "literal", columns: Sequence[str] | None = None) -> DataFrame:
        """the rows of the table (its own columns) that hold the term in one of the columns."""
        columns = list(columns or self.columns)
        if not set(columns) <= set(self.columns):
            raise ValueError(f"columns {sorted(set(columns) - set(self.columns))} are not in the index")
        some, found = self.rows, self.candidates(term, mode)
        if found is not None:
            path = scratch(some.sparkSession, "found")
            found.write.parquet(path)  # looked at twice: for the ranges, and for the rows
            found = some.sparkSession.read.schema(found.schema).parquet(path)
            listed = [r["row"] for r in found.limit(LISTED + 1).collect()]
            if len(listed) <= LISTED:
                some = some.where(_in_ranges(ranges(sorted(listed))))
            some = some.join(found, "row", "left_semi")
        return some.where(substring_any(columns, term, mode)).drop("row")


def ranges(numbers: list[int], most: int = RANGES) -> list[tuple[int, int]]:
    """At most so many ranges that hold all of the sorted numbers: the widest gaps are left out."""
    if not numbers:
        return []
    gaps = sorted(range(1, len(numbers)), key=lambda i: numbers[i - 1] - numbers[i])[: most - 1]
    cuts = [0, *sorted(g for g in gaps if numbers[g] - numbers[g - 1] > 1), len(numbers)]
    return [(numbers[a], numbers[b - 1]) for a, b in zip(cuts, cuts[1:])]


def _in_ranges(spans: list[tuple[int, int]]) -> Column:
    out = F.lit(False)
    for low, high in spans:
        out = out | F.col("row").between(low, high)
    return out


def build_trigram_index(df: DataFrame, columns: Sequence[str], path: str | None = None) -> TrigramIndex:
    """Store a table with its trigram index (``path`` None: in the session's shared scratch folder)."""
    spark = df.sparkSession
    if "row" in df.columns:
        raise ValueError("the table has a column 'row'; rename it")
    path = path or scratch(spark, "trigrams")
    # a number's low 33 bits count the rows of a file, so 4096 neighbours share a part
    df.withColumn("row", F.monotonically_increasing_id()).write.mode("overwrite").parquet(f"{path}/rows")
    stored = spark.read.parquet(f"{path}/rows")
    ship_package(spark)
    texts = [F.lower(F.col(c).cast("string")).alias(f"c{i}") for i, c in enumerate(columns)]
    some = stored.select("row", *texts).mapInArrow(gram_lists, "gram string, part long, rows array<long>")
    # few lists of a trigram meet in a part: those of the same file that were sorted apart
    lists = some.groupBy("gram", "part").agg(F.flatten(F.collect_list("rows")).alias("rows"))
    lists = lists.select("gram", "part", F.size("rows").alias("n"), F.sort_array("rows").alias("rows"))
    lists = lists.repartitionByRange("gram", "part").sortWithinPartitions("gram", "part")
    lists.write.mode("overwrite").parquet(f"{path}/lists")
    grams = spark.read.parquet(f"{path}/lists").groupBy("gram").agg(F.sum("n").cast("long").alias("n"))
    grams.orderBy("gram").write.mode("overwrite").parquet(f"{path}/grams")
    spark.createDataFrame([(list(columns),)], "columns array<string>").coalesce(1).write.mode("overwrite").parquet(f"{path}/columns")
    return TrigramIndex.load(spark, path)
