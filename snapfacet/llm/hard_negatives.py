"""Operator 12, hard negatives by rotated one-bit codes.

Vectors become whole numbers (floor of ``scale`` times each component); a score is the inner product
of two of them. The index keeps, for each vector o, the signs of its components after a fixed random rotation, as
a unit vector c of one bit a component, and beside it the alignment <o, c> and the length of the residual
o - <o, c> c. A query q is rotated too and cut into bit planes of small whole numbers, so <q, c> comes
from popcounts of the planes with the codes, up to the length of what the planes leave out. Then

    <q, o> = <o, c> <q, c> + <q, o - <o, c> c>,

and by Cauchy and Schwarz the last term is at most the residual's length times the length of the part of q
that is orthogonal to c. So every score lies, without any chance, in an interval that is known before
a component is read. Rows whose interval cannot reach the k-th best so far, or lies outside the
window wanted, are passed over; the others are scored in whole numbers, highest upper ends first.
Rounding is covered by a slack of the intervals.

Two searches are made: for each anchor its best rows of the same label, and then, for each of
these positives, the best rows of other labels whose score is in a window between two shares of the positive's.

All anchors are a stated query set, held in blocks against all rows: the index is dealt to parts of about
``part`` vectors by a hash of the row's number, each anchor is sent to every part, and a task holds one part
while the anchors stream past it. A part answers with k rows a question; these are merged by question. Nothing depends on
labels for its place, so a label held by a third of all rows is spread like any other.

Defined results: rows with a null id, label or vector, or a null or non-finite component, are neither
anchors nor found; a vector of no components, and what is missing from a shorter one, counts as zero; a row's
own row is left out, another row with the same id or vector is not; repeated anchors have rows of their own; a
positive of score below zero has an empty window; vectors too long for 64-bit scores are an error, not
dropped; empty tables give an empty result. Other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, scratch, ship_package, table
from . import blocks as B

PART = 65_536
PLANES, STEP = 8, 1024
SEED = 20240612
_U = np.uint64
ROW = "row long, id long, label long, length double, aligned double, rest double, code binary, vector binary"


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table of the shared folder."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def rotation(dims: int, seed: int = SEED) -> np.ndarray:
    """A fixed random rotation of ``dims`` dimensions."""
    q, r = np.linalg.qr(np.random.Generator(np.random.PCG64(seed)).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def pack_bits(on: np.ndarray) -> np.ndarray:
    """Rows of marks as 64-bit words."""
    wide = np.zeros((len(on), -(-on.shape[1] // 64) * 64), bool)
    wide[:, : on.shape[1]] = on
    return np.packbits(wide, axis=1, bitorder="little").view("<u8")


def encode(vectors: np.ndarray, turn: np.ndarray):
    """(codes, alignment with the code, length of the residual, length) of whole-number vectors."""
    turned = vectors @ turn.T
    on = turned >= 0
    aligned = np.abs(turned).sum(axis=1) / math.sqrt(len(turn))
    length = np.sqrt((vectors * vectors).sum(axis=1))
    rest = np.sqrt(np.maximum(0, length * length - aligned * aligned))
    return pack_bits(on), aligned, rest, length


class Query:
    """One anchor, cut into bit planes."""

    def __init__(self, vector: np.ndarray, turn: np.ndarray):
        self.length = math.sqrt(float((vector * vector).sum()))
        turned = turn @ vector
        top = (1 << PLANES - 1) - 1
        self.unit = float(np.abs(turned).max()) / top or 1.0
        whole = np.rint(turned / self.unit).astype(np.int64)
        self.left_out = float(np.sqrt(((turned - whole * self.unit) ** 2).sum()))
        self.total = int(whole.sum())
        raised = whole + top + 1
        self.offset = top + 1
        self.planes = [pack_bits(((raised >> p) & 1).astype(bool)[None])[0] for p in range(PLANES)]
        self.dims = len(turn)

    def interval(self, codes: np.ndarray, ones: np.ndarray, aligned: np.ndarray, rest: np.ndarray, length: np.ndarray):
        """Lower and upper ends of the scores with some rows of the index."""
        raised = np.zeros(len(codes), np.int64)
        for p, plane in enumerate(self.planes):
            raised += np.bitwise_count(codes & plane).sum(axis=1, dtype=np.int64) << p
        positive = raised - self.offset * ones  # sum of the query's numbers where the code is +1
        along = (2 * positive - self.total) * (self.unit / math.sqrt(self.dims))
        low = np.maximum(0, np.abs(along) - self.left_out)
        across = np.sqrt(np.maximum(0, self.length**2 - low * low))
        reach = aligned * self.left_out + rest * across + 1e-9 * self.length * length + 1e-6
        return aligned * along - reach, aligned * along + reach


class Part:
    """One part of the index, in the order of its labels."""

    def __init__(self, rows: dict[str, np.ndarray]):
        order = np.lexsort((rows["row"], rows["id"], rows["label"]))
        for name, values in rows.items():
            setattr(self, name, values[order])
        self.ones = np.bitwise_count(self.code).sum(axis=1, dtype=np.int64)
        self.scored = self.seen = 0

    def span(self, label: int) -> slice:
        return slice(int(np.searchsorted(self.label, label, "left")), int(np.searchsorted(self.label, label, "right")))

    def intervals(self, q: Query, s: slice):
        return q.interval(self.code[s], self.ones[s], self.aligned[s], self.rest[s], self.length[s])

    def scores(self, vector: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Whole-number scores: in doubles where these hold every sum exactly."""
        self.scored += len(rows)
        some = self.vector[rows]
        if float(self.length[rows].max(initial=0)) * math.sqrt(float((vector.astype(float) ** 2).sum())) < 2**52:
            return (some.astype(float) @ vector.astype(float)).astype(np.int64)
        return some.astype(np.int64) @ vector.astype(np.int64)

    def best(self, rows: np.ndarray, high: np.ndarray, vector: np.ndarray, windows: list, k: int) -> list:
        """For each window (lowest, highest score) the first k of the given rows by score and id; ``high`` are
        the upper ends. Rows are scored from the highest end on until no window can change."""
        order = np.argsort(-high, kind="stable")
        rows, high = rows[order], high[order]
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in windows]
        never = np.iinfo(np.int64).max
        need = [a if a <= b else never for a, b in windows]  # what a row must reach to matter to each window
        lo, step = 0, STEP // 8
        while lo < len(rows) and high[lo] >= min(need):
            hi = lo + max(1, int(np.searchsorted(-high[lo : lo + step], -min(need), "right")))
            now = rows[lo:hi]
            score = self.scores(vector, now)
            for w, (least, most) in enumerate(windows):
                ok = (score >= need[w]) & (score <= most)
                s, r = np.append(found[w][0], score[ok]), np.append(found[w][1], now[ok])
                top = np.lexsort((self.row[r], self.id[r], -s))[:k]
                found[w] = s[top], r[top]
                if len(top) == k:
                    need[w] = max(least, int(s[top[-1]]))
            lo, step = hi, STEP
        return found


def index(rows: DataFrame, id_col: str, vector_col: str, label: Column, scale: int) -> tuple[DataFrame, int]:
    """The rows that take part, with their number, codes and whole numbers; and the number of dimensions."""
    v = B.quoted(vector_col).cast("array<double>")
    some = rows.select(B.quoted(id_col).cast("long").alias("id"), label.cast("long").alias("label"), v.alias("v"))
    good = F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    some = some.where(good & ~F.coalesce(bad, F.lit(False)))
    # the number of a row is fixed by the write
    some = written(some.withColumn("row", F.monotonically_increasing_id()).withColumn("part", F.pmod(F.xxhash64("row"), F.lit(1 << 30))), "vectors")
    dims = some.agg(F.max(F.size("v")).alias("n")).first()["n"] or 0
    turn = rotation(max(1, dims))

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            lists = batch.column("v")
            size = lists.value_lengths().to_numpy(zero_copy_only=False)
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            whole = np.zeros((n, max(1, dims)))
            at = np.repeat(np.arange(n), size)
            whole[at, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = np.floor(flat * scale)
            code, aligned, rest, length = encode(whole, turn)
            if n and length.max() >= 2**31:
                raise ValueError("a vector is too long for 64-bit scores")
            kept = whole.astype(np.int32) if n and np.abs(whole).max() < 2**31 else whole.astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("row", "id", "label")),
                    pa.array(length),
                    pa.array(aligned),
                    pa.array(rest),
                    pa.array([c.tobytes() for c in code], pa.binary()),
                    pa.array([x.astype(np.int64).tobytes() if kept.dtype == np.int64 else x.tobytes() for x in kept], pa.binary()),
                    batch.column("part"),
                ],
                ["row", "id", "label", "length", "aligned", "rest", "code", "vector", "part"],
            )

    return written(some.mapInArrow(run, f"{ROW}, part long"), "index"), dims


def _numbers(column, dims: int) -> np.ndarray:
    """Packed whole-number vectors (of 4 or 8 bytes a number) as rows."""
    values = [v.as_buffer() for v in column]
    if all(len(v) == 4 * dims for v in values):
        return np.frombuffer(b"".join(values), "<i4").reshape(len(values), dims)
    return np.array([np.frombuffer(v, "<i4" if len(v) == 4 * dims else "<i8").astype(np.int64) for v in values]).reshape(len(values), dims)


def _part(batches: list, dims: int) -> Part:
    t = pa.Table.from_batches(batches)
    col = lambda c: t[c].to_numpy()
    code = np.frombuffer(b"".join(x.as_buffer() for x in t["code"]), "<u8").reshape(t.num_rows, -1)
    rows = {c: col(c) for c in ("row", "id", "label", "length", "aligned", "rest")}
    return Part(rows | {"code": code, "vector": _numbers(t["vector"], dims)})


def _streamed(dims: int, ask):
    """Rows sorted by part, index rows (``asked`` is null) before the anchors: hold a part while its anchors
    stream past. ``ask(part, batch of anchors)`` gives columns anchor, question, row, id, score."""
    turn = rotation(dims)
    names = ["anchor", "question", "row", "id", "score"]

    def run(batches):
        number, rows, part = None, [], None
        for batch in batches:
            parts = batch.column("part").to_numpy(zero_copy_only=False)
            asked = ~np.asarray(batch.column("asked").is_null())
            cuts = np.flatnonzero(np.append(True, (parts[1:] != parts[:-1]) | (asked[1:] != asked[:-1]))) if len(parts) else []
            for a, b in zip(cuts, [*cuts[1:], len(parts)]):
                some = batch.slice(int(a), int(b - a))
                if parts[a] != number:
                    number, rows, part = parts[a], [], None
                if not asked[a]:
                    rows.append(some)
                    continue
                if part is None and rows:
                    part, rows = _part(rows, dims), []
                if part is not None:
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in ask(part, some, turn)], names)

    return run


def _ask_positives(dims: int, k: int):
    def ask(part: Part, anchors, turn):
        out = []
        vectors = _numbers(anchors.column("vector"), dims)
        for row, label, v in zip(anchors.column("row").to_pylist(), anchors.column("label").to_pylist(), vectors):
            s = part.span(label)
            _, high = part.intervals(Query(v.astype(float), turn), s)
            part.seen += len(high)
            rows = np.arange(s.start, s.stop)
            other = part.row[s] != row
            low = np.iinfo(np.int64).min
            score, found = part.best(rows[other], high[other], v, [(low, -low - 1)], k)[0]
            out.append((np.full(len(found), row), np.zeros(len(found), np.int64), part.row[found], part.id[found], score))
        return [np.concatenate(x) for x in zip(*out)]

    return ask


def _ask_negatives(dims: int, k: int, shares: tuple[int, int]):
    def ask(part: Part, anchors, turn):
        out = [tuple(np.zeros(0, np.int64) for _ in range(5))]
        vectors = _numbers(anchors.column("vector"), dims)
        for row, label, v, positives in zip(anchors.column("row").to_pylist(), anchors.column("label").to_pylist(), vectors, anchors.column("asked").to_pylist()):
            windows = [(-(-shares[0] * p // 100), shares[1] * p // 100) for p in positives]
            if not any(a <= b for a, b in windows):
                continue
            least, most = min(a for a, b in windows if a <= b), max(b for a, b in windows if a <= b)
            low, high = part.intervals(Query(v.astype(float), turn), slice(0, len(part.row)))
            part.seen += len(high)
            same = part.span(label)
            ok = (high >= least) & (low <= most)
            ok[same] = False
            rows = np.flatnonzero(ok)
            for question, (score, found) in enumerate(part.best(rows, high[rows], v, windows, k)):
                out.append((np.full(len(found), row), np.full(len(found), question), part.row[found], part.id[found], score))
        return [np.concatenate(x) for x in zip(*out)]

    return ask


def _search(held: DataFrame, anchors: DataFrame, parts: int, dims: int, ask, k: int) -> DataFrame:
    """The first k rows of each (anchor, question), with their ``rank``. ``anchors`` have a column ``asked``."""
    dims = max(1, dims)
    mine = held.withColumn("part", F.col("part") % parts).withColumn("asked", F.lit(None).cast("array<long>"))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long")))
    sent = anchors.withColumn("part", every).select(*mine.columns).unionByName(mine)
    sent = sent.withColumn("later", F.col("asked").isNotNull())
    # a row of the index has some 300 bytes, so Arrow batches stay small beside a part
    sorted_ = sent.repartitionByRange(parts, "part").sortWithinPartitions("part", "later", "label", "row").drop("later")
    found = sorted_.mapInArrow(_streamed(dims, ask), "anchor long, question long, row long, id long, score long")
    order = Window.partitionBy("anchor", "question").orderBy(F.desc("score"), "id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    rows: DataFrame,
    anchor: Column,
    id_col: str = "id",
    vector_col: str = "embedding",
    label: Column | None = None,
    positives: int = 5,
    negatives: int = 10,
    shares: tuple[int, int] = (30, 90),
    scale: int = 256,
    part: int = PART,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``: for each row whose
    id makes ``anchor`` (a condition on the column ``id``) true, and each of its ``positives`` best rows of the
    same label, the ``negatives`` best rows of other labels with a score of ``shares`` per cent of the positive's."""
    spark = rows.sparkSession
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    held, dims = index(rows, id_col, vector_col, F.col("label") if label is None else label, scale)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(held.count() / part))
    anchors = held.where(anchor)
    none = anchors.withColumn("asked", F.array().cast("array<long>"))
    first = _search(held, none, parts, dims, _ask_positives(max(1, dims), positives), positives)
    first = written(first.select("anchor", F.col("rank").alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    # the positives' scores in the order of their rank: at most ``positives`` numbers an anchor
    listed = F.transform(F.array_sort(F.collect_list(F.struct("place", "positive_score"))), lambda p: p["positive_score"])
    asked = first.groupBy("anchor").agg(listed.alias("asked")).withColumnRenamed("anchor", "row")
    second = _search(held, anchors.join(asked, "row"), parts, dims, _ask_negatives(max(1, dims), negatives, shares), negatives)
    second = second.select("anchor", (F.col("question") + 1).cast("int").alias("place"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    out = second.join(first, ["anchor", "place"]).join(named, "anchor")
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op12_hard_negatives(spark, sf_dir: str) -> DataFrame:
    """Contract query over ``embeddings``: every vector whose id is divisible by 100 against all rows; labels of
    ids divisible by 7 are moved on by one."""
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return mine(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, "vec_id", "embedding", moved)


OP12_SQL = """
WITH v AS (
    SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
      list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x
    FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  s AS MATERIALIZED (
    SELECT a.r AS a, a.vec_id AS anchor_id, b.r AS b, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
    FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.r <> b.r),
  p AS (SELECT a, anchor_id, b, id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, id) <= 5),
  n AS (SELECT anchor_id, positive_id, positive_score, id AS negative_id, score AS negative_score,
      row_number() OVER (PARTITION BY p.a, p.b ORDER BY score DESC, id) AS rank
    FROM p JOIN s USING (a, anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""
