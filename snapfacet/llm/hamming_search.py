"""Operator 6, exact top-k search over binary codes by incremental multi-index hashing.

Codes of up to 64 bits are cut into segments, and each segment value is a key of an index. A code
at Hamming distance d from the query has a segment within d // m bits of the query's (m
segments), so after all segment values within r bits have been looked up, everything at distance
m * (r + 1) - 1 or less has been found. The radius grows by one bit per round; each round looks
up, for the queries that are not finished, the segment values at that radius alone, verifies the
true distance of what they hold and keeps the best. A query is finished when its k-th verified
distance is covered, or when the radius has reached the whole segment. So the result is exact,
ties included: they go to the smaller id.

The index is dealt out by segment and by the first bits of its value, as many as the number of
codes needs for about ``BLOCK`` codes a part; a query goes to the parts whose first bits are within
the radius. A part answers each query with its k + 1 best, not with all it has looked at. Queries
come in blocks of at most ``QUERIES``. Equal codes are one entry of the index with their k + 1
smallest ids, so a code held by a third of all rows is one entry. Rounds are checkpointed, so a
lost executor repeats one round.

Defined results: rows with a null id, or with a null or empty vector or a null in it, are neither
queries nor found; numbers missing from a short vector count as not over zero; a table with k codes
or fewer gives all it has; an empty table gives an empty result. Equal rows are found as often as
they are there, but for the query's own id.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, ship_package, table
from . import blocks as B

BLOCK, QUERIES = 65_536, 200_000
_U = np.uint64


def sign_codes(rows: DataFrame, id_col: str, vector_col: str, bits: int) -> DataFrame:
    """``id`` and ``code`` (a long): for each of ``bits`` numbers a bit that is 1 where it is over
    zero. A fixed rule, so nothing is learnt from the rows."""
    v = B.quoted(vector_col)
    bit = lambda i: F.when(F.get(v, F.lit(i)) > 0, F.shiftleft(F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long"))
    code = bit(0)
    for i in range(1, bits):
        code = code.bitwiseOR(bit(i))
    ok = B.quoted(id_col).isNotNull() & v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull())
    return rows.where(ok).select(B.quoted(id_col).cast("long").alias("id"), code.alias("code"))


def masks(width: int, radius: int) -> np.ndarray:
    """All values of ``width`` bits with ``radius`` bits set."""
    return np.array([sum(1 << b for b in c) for c in combinations(range(width), radius)], dtype=np.uint64)


class _Layout:
    """Segments of a code, and the parts of the index: (segment, first bits of its value)."""

    def __init__(self, bits: int, segment: int, parts_bits: int):
        self.cuts = [(s, min(segment, bits - s)) for s in range(0, bits, segment)]
        self.top = [min(parts_bits, w) for _, w in self.cuts]

    def value(self, code: np.ndarray, i: int) -> np.ndarray:
        start, width = self.cuts[i]
        return (code >> _U(start)) & _U((1 << width) - 1)

    def part(self, value: np.ndarray, i: int) -> np.ndarray:
        return value >> _U(self.cuts[i][1] - self.top[i])


def _deal_codes(layout: _Layout, blocks: int):
    """Each code to its part of every segment, for each block of queries."""

    def run(batches):
        for batch in batches:
            code = batch.column("code").to_numpy(zero_copy_only=False).view(np.uint64)
            for i in range(len(layout.cuts)):
                part = pa.array(layout.part(layout.value(code, i), i).astype(np.int64), pa.int64())
                for block in range(blocks):
                    same = [pa.array(np.full(len(code), x), pa.int64()) for x in (i, block)]
                    yield pa.RecordBatch.from_arrays([same[0], part, same[1], *batch.columns], ["segment", "part", "block", "code", "ids"])

    return run


def _deal_queries(layout: _Layout, blocks: int, radius: int):
    """Each query to the parts whose first bits are within the radius, in its block."""

    def run(batches):
        for batch in batches:
            code = batch.column("asked").to_numpy(zero_copy_only=False).view(np.uint64)
            block = (code % _U(blocks)).astype(np.int64)
            for i, top in enumerate(layout.top):
                mine = layout.part(layout.value(code, i), i)
                for r in range(min(radius, top) + 1):
                    for mask in masks(top, r):
                        part = (mine ^ mask).astype(np.int64)
                        cols = [np.full(len(code), i), part, block, code.view(np.int64)]
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["segment", "part", "block", "asked"])

    return run


def _look_up(layout: _Layout, radius: int, best: int):
    def run(index: pa.Table, asked: pa.Table) -> pa.Table:
        out_q, out_at, out_d = [], [], []
        if index.num_rows and asked.num_rows:
            i = index["segment"][0].as_py()
            code = index["code"].to_numpy().view(np.uint64)
            value = layout.value(code, i)
            order = np.argsort(value, kind="stable")
            value, code = value[order], code[order]
            ring = masks(layout.cuts[i][1], radius)
            # the index's own values, and where the codes of each begin
            first = np.flatnonzero(np.append(True, value[1:] != value[:-1]))
            end = np.append(first[1:], len(value))
            known = value[first]
            for q in asked["asked"].to_numpy().view(np.uint64):
                want = layout.value(q, i) ^ ring
                if len(known) < len(want):  # fewer values than probes: look from the other side
                    hit = np.flatnonzero(np.bitwise_count(known ^ layout.value(q, i)) == radius)
                else:
                    at = np.minimum(np.searchsorted(known, want), len(known) - 1)
                    hit = at[known[at] == want]
                if not len(hit):
                    continue
                n = end[hit] - first[hit]
                at = np.repeat(first[hit] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                d = np.bitwise_count(code[at] ^ q).astype(np.int64)
                if len(at) > best:  # all that are as near as the ``best``-th: ties are cut later
                    near = np.flatnonzero(d <= np.partition(d, best - 1)[best - 1])
                    at, d = at[near], d[near]
                out_q.append(np.full(len(at), q))
                out_at.append(order[at])
                out_d.append(d)
        q = np.concatenate(out_q).view(np.int64) if out_q else np.zeros(0, np.int64)
        at = np.concatenate(out_at) if out_at else np.zeros(0, np.int64)
        d = np.concatenate(out_d) if out_d else np.zeros(0, np.int64)
        ids = index["ids"].combine_chunks() if index.num_rows else pa.array([], pa.list_(pa.int64()))
        code = index["code"].combine_chunks() if index.num_rows else pa.array([], pa.int64())
        pick = pa.array(at, pa.int64())
        return pa.table({"q": pa.array(q, pa.int64()), "code": code.take(pick), "distance": pa.array(d, pa.int64()), "ids": ids.take(pick)})

    return run


def top_k(codes: DataFrame, queries: DataFrame, bits: int = 64, k: int = 10, segment: int = 16, block: int = BLOCK) -> DataFrame:
    """For each row of ``queries`` (id, code) the k rows of ``codes`` (id, code) of the smallest
    distance: ``query_id``, ``rank``, ``id``, ``distance``. The query's own id is left out."""
    if not 0 < bits <= 64:
        raise ValueError("codes have 1 to 64 bits")
    spark = codes.sparkSession
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    # k + 1 smallest ids of each code: one of them may be the query's own. The filter on the row
    # number limits each task's rows before the shuffle, so a frequent code stays small.
    least = Window.partitionBy("code").orderBy("id")
    held = codes.withColumn("n", F.row_number().over(least)).where(F.col("n") <= k + 1)
    index = held.groupBy("code").agg(F.array_sort(F.collect_list("id")).alias("ids")).checkpoint()
    open_ = queries.select(F.col("code").alias("asked")).distinct().checkpoint()
    n, asked = index.count(), open_.count()
    layout = _Layout(bits, segment, max(0, math.ceil(math.log2(max(1, n) / block))))
    blocks, m = max(1, math.ceil(asked / QUERIES)), len(layout.cuts)
    key = ["segment", "part", "block"]
    dealt = index.mapInArrow(_deal_codes(layout, blocks), "segment long, part long, block long, code long, ids array<long>")
    found, radius = None, 0
    while asked and radius <= segment:
        sent = open_.mapInArrow(_deal_queries(layout, blocks, radius), "segment long, part long, block long, asked long")
        pairs = dealt.groupBy(*key).cogroup(sent.groupBy(*key))
        near = pairs.applyInArrow(_look_up(layout, radius, k + 1), "q long, code long, distance long, ids array<long>")
        if found is not None:
            near = near.union(found)
        near = near.dropDuplicates(["q", "code"])
        order = Window.partitionBy("q").orderBy("distance", F.element_at("ids", 1))
        # k + 1 codes hold at least k rows beside the query's own
        found = near.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1).drop("n").checkpoint()
        covered = m * (radius + 1) - 1
        rows = found.groupBy("q").agg(F.sum(F.when(F.col("distance") <= covered, F.size("ids"))).alias("rows"))
        open_ = open_.join(rows.where(F.col("rows") > k), F.col("asked") == F.col("q"), "left_anti").checkpoint()
        asked, radius = open_.count(), radius + 1
    each = queries.select(F.col("id").alias("query_id"), F.col("code").alias("asked"))
    if found is None:
        found = spark.createDataFrame([], "q long, code long, distance long, ids array<long>")
    hits = found.select(F.col("q").alias("asked"), "distance", F.explode("ids").alias("id"))
    hits = each.join(hits, "asked").where(F.col("id") != F.col("query_id"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "id"))
    return hits.select("query_id", rank.alias("rank"), "id", F.col("distance").cast("int").alias("distance")).where(F.col("rank") <= k)


def op6_exact_top_k(spark, sf_dir: str) -> DataFrame:
    """The 10 nearest codes of every vector whose id is divisible by 100, against all of
    ``embeddings``: 64 sign bits."""
    codes = sign_codes(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 64)
    return top_k(codes, codes.where(F.col("id") % 100 == 0), bits=64, k=10)


OP6_SQL = """
WITH v AS (SELECT vec_id, embedding FROM embeddings WHERE len(embedding) > 0),
  q AS (SELECT * FROM v WHERE vec_id % 100 = 0),
  d AS (SELECT q.vec_id AS query_id, v.vec_id AS id,
          CAST(list_sum(list_transform(range(1, 65), lambda i: CASE WHEN (q.embedding[i] > 0) <> (v.embedding[i] > 0) THEN 1 ELSE 0 END)) AS INTEGER) AS distance
        FROM q JOIN v ON q.vec_id <> v.vec_id),
  r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank FROM d)
SELECT query_id, CAST(rank AS INTEGER) AS rank, id, distance FROM r WHERE rank <= 10
"""
