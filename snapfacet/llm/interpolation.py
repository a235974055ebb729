"""Operator 9, language-model scoring by deleted interpolation.

The probability of a token is a mixture of its maximum-likelihood estimates after two, one and no
words, and of the uniform one: l3*c(abc)/c(ab) + l2*c(bc)/c(b) + l1*c(c)/N + l0/(V+1). The
weights depend on how frequent the context is: each power of two of c(ab), or of c(b) where ab is
new, is a bucket with weights of its own. They are learnt by expectation-maximisation on deleted
counts: each training token in turn is held out, its own occurrence taken out of all counts.

Counting and looking up use packed keys (``blocks``): every chunk of documents sends its distinct
words and word pairs with their numbers of occurrences, the buckets add them up over the corpus
and send each chunk the totals of its own keys; then word triples follow, but only those whose two
pairs both occur elsewhere (the others are counted by that alone). Nothing is capped or sampled,
so what is gathered grows with the corpus. Where each token's counts are known they are written
once; the weights come from a histogram of the held-out tokens' estimates with a fixed number of
cells, summed by Spark.

Tokens are lower-cased words, then one end. Defined results: null or empty text is the end token
alone; repeated rows count as often as they are there; a null id is a training row (its id has no
crc32); without training rows all counts are zero and every token has the uniform estimate. Other
columns, whatever their names, are in ``row``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir, ship_package, table
from . import blocks as B
from . import words as W

ONE, TWO, THREE = 1, 2, 3
_U = np.uint64
#: Histogram cells: quarters of a power of ten, down to 10**-12 (0 apart), and context buckets.
STEPS, FLOOR = 4, 12
BUCKETS = 64
#: Bytes of text in a chunk: a larger one has fewer distinct n-grams for its size. Two different
#: pairs or triples of words share a key with a chance under 2**-SPARE.
CHUNK, SPARE = 6 << 20, 20


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return W.mix(a * _U(0x9E3779B97F4A7C15) + b)


@dataclass
class _Tokens:
    """The tokens of a chunk, the end of each row included, and their n-gram keys."""

    row: np.ndarray
    first: np.ndarray  # first token of each row
    keys: dict[int, np.ndarray]
    train: np.ndarray  # by token

    @property
    def n(self) -> int:
        return len(self.row)


def _tokens(chunk: pa.Table) -> _Tokens:
    data, offsets = B.texts(chunk["_text"])
    rows, _, _, h = W.words(data, offsets, W.NOT_SPACE, W.LOWER)
    n = chunk.num_rows
    first = np.searchsorted(rows, np.arange(n + 1), "left") + np.arange(n + 1)  # one end a row
    word = np.full(len(h) + n, W.END)
    word[np.arange(len(h)) + rows] = h
    row = np.repeat(np.arange(n), np.diff(first))
    before = np.append(W.START, word[:-1])
    before[first[:-1]] = W.START
    two = _pair(before, word)
    head = np.append(_U(0), two[:-1])
    head[first[:-1]] = W.mix(np.array([W.START]))[0]
    train = chunk["_train"].combine_chunks().to_numpy(zero_copy_only=False).astype(bool)[row]
    return _Tokens(row, first, {ONE: word, TWO: two, THREE: _pair(head, word)}, train)


def _shifted(a: np.ndarray, first: np.ndarray, start: int) -> np.ndarray:
    """The value of the token before (``start`` for the first of a row)."""
    out = np.append(a[:0], a)
    out[1:] = a[:-1]
    out[first[:-1]] = start
    return out


class _Counter:
    """Sends a chunk's distinct keys and gives its tokens the totals that come back."""

    def __init__(self, layout: B.Layout):
        self.layout = layout

    def _distinct(self, t: _Tokens, level: int, at: np.ndarray):
        bits = 64 if level == ONE else self.layout.bits(SPARE)
        keys = t.keys[level][at] >> _U(64 - bits)
        order, first = B.groups(keys) if len(keys) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        return bits, keys, order, first

    def send(self, chunk: int, t: _Tokens, level: int, at: np.ndarray) -> list:
        bits, keys, order, first = self._distinct(t, level, at)
        if not len(keys):
            return []
        trained = np.add.reduceat(t.train[at][order].astype(np.int64), first)
        held = np.diff(np.append(first, len(keys))) - trained
        return B.blocks(chunk, level, self.layout, keys[order][first], trained, held, bits=bits)

    def totals(self, t: _Tokens, level: int, at: np.ndarray, got: pa.Table) -> tuple[np.ndarray, ...]:
        """For the tokens ``at``: training occurrences of the key; 1 where it occurs twice at all;
        1 where this chunk counts the key for the vocabulary."""
        _, keys, order, first = self._distinct(t, level, at)
        answers = [
            (b, B.unpack(x))
            for b, lv, x in zip(got["_bucket"].to_pylist(), got["_level"].to_pylist(), got["_block"].to_pylist())
            if lv == level
        ]
        answers.sort(key=lambda a: a[0])
        total = np.concatenate([a[1][0] for a in answers]).astype(np.int64) if answers else np.zeros(0, np.int64)
        mine = np.empty(len(keys), np.int64)
        mine[order] = np.repeat(total, np.diff(np.append(first, len(keys))))
        return mine >> 2, mine >> 1 & 1, mine & 1


def _add_up(level: int, keys, owner, trained, held):
    """Of each key, in one number: training occurrences; whether it occurs twice at all; for words
    also 1 for one of the chunks that have it, so that the chunks can count the vocabulary."""
    total = B.per_key(keys, trained.astype(np.int64), np.add)
    several = (total + B.per_key(keys, held.astype(np.int64), np.add)) > 1
    out = total << 2 | several.astype(np.int64) << 1
    if level == ONE:
        order, first = B.groups(keys)
        out[order[first]] |= 1
    return None, (out,)


COUNTS = T.StructType().add("rows", "binary").add("n_tokens", "long").add("train_tokens", "long").add("train_rows", "long")
COUNTS = COUNTS.add("types", "long").add("sizes", "binary").add("train", "binary").add("counts", "binary")


def ngram_counts(docs: DataFrame, train, text_col: str = "text", id_col: str = "doc_id", chunk=None, per_bucket=None) -> DataFrame:
    """One row per chunk of documents: ``rows`` (their other columns), and packed: tokens of each,
    whether it is a training row, and for each token its training counts as c(c), c(bc), c(abc).
    ``train`` is a boolean column of ``docs``."""
    ship_package(docs.sparkSession)
    marked = docs.withColumn("_train_row", F.coalesce(train, F.lit(True)))
    dealt, layout = B.chunked(marked, id_col, text_col, chunk or CHUNK, per_bucket)
    dealt = dealt.withColumn("_train", F.col("_rest")["_train_row"])
    counter = _Counter(layout)
    kind = dealt.schema["_rest"].dataType

    def small(table: pa.Table) -> pa.Table:
        t, chunk = _tokens(table), table["_chunk"][0].as_py()
        at = np.arange(t.n)
        return B.to_table(counter.send(chunk, t, ONE, at) + counter.send(chunk, t, TWO, at))

    def candidates(t: _Tokens, got: pa.Table):
        """Counts of words and pairs; tokens whose triple may occur elsewhere too."""
        at = np.arange(t.n)
        one, two = counter.totals(t, ONE, at, got), counter.totals(t, TWO, at, got)
        known = (two[1] > 0) & (_shifted(two[1], t.first, 1) > 0)
        return one, two, np.flatnonzero(known)

    def large(table: pa.Table, got: pa.Table) -> pa.Table:
        t = _tokens(table)
        _, _, at = candidates(t, got)
        return B.to_table(counter.send(table["_chunk"][0].as_py(), t, THREE, at))

    def finish(table: pa.Table, got: pa.Table) -> pa.Table:
        t = _tokens(table)
        one, two, at = candidates(t, got)
        three = t.train.astype(np.int64)  # alone in the corpus: counted once, if it is trained on
        three[at] = counter.totals(t, THREE, at, got)[0]
        train = table["_train"].combine_chunks().to_numpy(zero_copy_only=False).astype(bool)
        # a word of this chunk that it counts for the vocabulary
        types = len(np.unique(t.keys[ONE][(one[2] > 0) & (one[0] > 0)]))
        rest = table["_rest"].combine_chunks()
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, pa.schema([("row", rest.type)])) as writer:
            writer.write_batch(pa.RecordBatch.from_arrays([rest], ["row"]))
        return pa.table(
            {
                "rows": pa.array([sink.getvalue().to_pybytes()], pa.binary()),
                "n_tokens": [t.n],
                "train_tokens": [int(t.train.sum())],
                "train_rows": [int(train.sum())],
                "types": [types],
                "sizes": pa.array([B.pack(np.diff(t.first))], pa.binary()),
                "train": pa.array([B.pack(train)], pa.binary()),
                "counts": pa.array([_pack_counts(one[0], two[0], three)], pa.binary()),
            }
        )

    # dealt by chunk here, the answers on words and pairs are one shuffle for both of their uses
    grouped = dealt.groupBy("_chunk")
    back = B.answer(grouped.applyInArrow(small, B.BLOCK), _add_up).repartition("_chunk")
    more = B.answer(grouped.cogroup(back.groupBy("_chunk")).applyInArrow(large, B.BLOCK), _add_up).repartition("_chunk")
    out = grouped.cogroup(back.union(more).groupBy("_chunk")).applyInArrow(finish, COUNTS)
    return out, kind


def _pack_counts(*counts: np.ndarray) -> bytes:
    """Counts by their rank among the chunk's distinct counts, the most frequent first."""
    out = []
    for c in counts:
        value, rank, n = np.unique(c, return_inverse=True, return_counts=True)
        order = np.argsort(-n, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        out += [value[order], place[rank]]
    return B.pack(*out, level=9)


def _unpack_counts(block: bytes) -> list[np.ndarray]:
    parts = B.unpack(block)
    return [value.astype(np.int64)[rank.astype(np.int64)] for value, rank in zip(parts[::2], parts[1::2])]


@dataclass
class Interpolation:
    tokens: int = 0  # N
    types: int = 0  # V
    rows: int = 0  # training rows: occurrences of the start context
    weights: np.ndarray = field(default_factory=lambda: np.tile([0.0, 0.0, 0.0, 1.0], (2 * BUCKETS, 1)))


def _estimates(model: Interpolation, first: np.ndarray, c1, c2, c3, deleted: np.ndarray):
    """(context bucket, the three maximum-likelihood estimates) of each token; where ``deleted``
    the token's own occurrence is not counted."""
    d = deleted.astype(np.int64)
    n1, n2 = _shifted(c1, first, model.rows), _shifted(c2, first, model.rows)
    # a token's occurrence is also one of its contexts
    n1, n2 = np.maximum(n1 - d, 0), np.maximum(n2 - d, 0)
    ratio = lambda c, n: np.where(n > 0, np.maximum(c - d, 0) / np.maximum(n, 1), 0.0)
    bucket = np.where(n2 > 0, BUCKETS + _log2(n2), np.where(n1 > 0, 1 + _log2(n1), 0))
    p1 = np.maximum(c1 - d, 0) / np.maximum(model.tokens - d, 1)
    return bucket, ratio(c3, n2), ratio(c2, n1), p1


def _log2(n: np.ndarray) -> np.ndarray:
    return np.minimum(np.frexp(np.maximum(n, 1).astype(float))[1] - 1, BUCKETS - 2)


def _cell(p: np.ndarray) -> np.ndarray:
    """0 for no chance, else the quarter power of ten from 1 (certain) on."""
    with np.errstate(divide="ignore"):
        q = np.round(-np.log10(p) * STEPS)
    return np.where(p > 0, 1 + np.clip(q, 0, STEPS * FLOOR), 0).astype(np.int64)


def _chance(cell: np.ndarray) -> np.ndarray:
    return np.where(cell > 0, 10.0 ** (-(cell - 1) / STEPS), 0.0)


def _opened(row: dict):
    (sizes,), (train,) = B.unpack(row["sizes"]), B.unpack(row["train"])
    return np.append(0, np.cumsum(sizes.astype(np.int64))), train.astype(bool), _unpack_counts(row["counts"])


def _records(batch, names):
    columns = [batch.column(n) for n in names]
    for i in range(batch.num_rows):
        yield {n: c[i].as_py() for n, c in zip(names, columns)}


def learn(counted: DataFrame, rounds: int = 60) -> Interpolation:
    """Weights by expectation-maximisation on the deleted estimates of all training tokens."""
    sums = counted.agg(*(F.sum(c) for c in ("train_tokens", "types", "train_rows"))).first()
    model = Interpolation(*(int(x or 0) for x in sums))

    def run(batches):
        for batch in batches:
            for row in _records(batch, ("sizes", "train", "counts")):
                first, train, counts = _opened(row)
                trained = np.repeat(train, np.diff(first))
                b, p3, p2, p1 = _estimates(model, first, *counts, deleted=trained)
                cells = ((b * 64 + _cell(p3)) * 64 + _cell(p2)) * 64 + _cell(p1)
                key, n = np.unique(cells[trained], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(n, pa.int64())], ["cell", "n"])

    # at most 2 * BUCKETS * 50**3 cells whatever the corpus; some ten thousand in practice
    cells = counted.select("sizes", "train", "counts").mapInArrow(run, "cell long, n long")
    rows = cells.groupBy("cell").agg(F.sum("n").alias("n")).collect()
    if not rows:
        return model
    key, n = (np.array([r[c] for r in rows], np.int64) for c in ("cell", "n"))
    p = np.column_stack([_chance(key >> 12 & 63), _chance(key >> 6 & 63), _chance(key & 63), np.full(len(key), 1 / (model.types + 1))])
    bucket = key >> 18
    weights = np.full((2 * BUCKETS, 4), 0.25)
    for _ in range(rounds):
        share = weights[bucket] * p
        share *= (n / share.sum(axis=1))[:, None]
        total = np.zeros_like(weights)
        np.add.at(total, bucket, share)
        some = total.sum(axis=1) > 0
        weights[some] = total[some] / total[some].sum(axis=1, keepdims=True)
    # a context that has not been seen gives no estimate; and no weight is ever zero
    weights[:1, :2] = 0
    weights[1:BUCKETS, 0] = 0
    weights = np.maximum(weights, 1e-9 * (weights > 0))
    weights[:, 3] = np.maximum(weights[:, 3], 1e-7)
    model.weights = weights / weights.sum(axis=1, keepdims=True)
    return model


def score(counted: DataFrame, kind: T.StructType, model: Interpolation) -> DataFrame:
    """Per document: ``row``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` (add-one unigrams) and ``score`` (the model's log10 probability)."""
    shared = counted.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for batch in batches:
            for row in _records(batch, ("rows", "sizes", "train", "counts")):
                first, train, (c1, c2, c3) = _opened(row)
                none = np.zeros(len(c1), bool)
                b, p3, p2, p1 = _estimates(m, first, c1, c2, c3, deleted=none)
                p = m.weights[b] * np.column_stack([p3, p2, p1, np.full(len(c1), 1 / (m.types + 1))])
                add = lambda x: np.add.reduceat(x, first[:-1])  # noqa: E731  every row has its end token
                base = np.log10((c1 + 1) / (m.tokens + m.types + 1))
                rows = pa.ipc.open_stream(row["rows"]).read_all()["row"].combine_chunks()
                n = len(train)
                cols = [rows, pa.array(~train), np.diff(first), add((c1 > 0).astype(np.int64)), np.full(n, m.tokens), add(base), add(np.log10(p.sum(axis=1)))]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in cols], schema.names)

    schema = T.StructType().add("row", kind).add("held_out", "boolean").add("n_tokens", "long").add("n_known", "long")
    schema = schema.add("train_tokens", "long").add("base_score", "double").add("score", "double")
    return counted.select("rows", "sizes", "train", "counts").mapInArrow(run, schema)


def interpolated_scores(docs: DataFrame, train, text_col: str = "text", id_col: str = "doc_id", chunk=None, per_bucket=None) -> DataFrame:
    """Learn from the rows where ``train`` holds and score all rows of ``docs``."""
    ensure_checkpoint_dir(docs.sparkSession)
    counted, kind = ngram_counts(docs, train, text_col, id_col, chunk, per_bucket)
    counted = counted.checkpoint()
    return score(counted, kind, learn(counted))


def op9_deleted_interpolation(spark, sf_dir: str) -> DataFrame:
    """Contract query: learnt from crc32(doc_id) mod 7 <> 2, all ``documents`` scored."""
    train = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2
    out = interpolated_scores(table(spark, sf_dir, "documents"), train)
    return out.select("row.doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
