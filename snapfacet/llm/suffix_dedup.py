"""Operator 8, suffix-array dedup over sparse suffixes.

A full suffix array has a suffix for every word. Here only the suffixes at minimiser positions
are retained: the places whose ``prefix_words`` leading words have the smallest hash of some
``min_words`` long window. The choice depends on the words alone, so two documents that share a
passage of ``min_words`` words retain the same suffix in it. The retained suffixes are sorted by
their leading words and neighbours compared (one packed key per chunk and suffix); a suffix
whose neighbour in another document starts alike is a match. Each match is then extended word
by word to the left and to the right, through the lengths at which ``min_words`` words hold it,
and the extended matches are sorted and compared again: an occurrence goes when a document with
a smaller id has the same ``min_words`` words. Overlapping matches join to the whole repeat.

Defined results: see ``substring_dedup`` (nulls, equal ids, repeated rows, empty tables, extra
columns); a document is never matched with itself, so inner repeats stay. A text without a
match is returned unchanged, a text made of repeats only becomes empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package, table
from . import blocks as B
from . import words as W

MATCHED, EXTENDED = 0, 1


def sliding(a: np.ndarray, size: int, how) -> np.ndarray:
    """``how`` (minimum or maximum) over each ``size`` neighbours, in log2(size) passes."""
    if len(a) < size:
        return a[:0]
    done, step = a, 1
    while step * 2 <= size:
        done = how(done[:-step], done[step:])
        step *= 2
    rest = size - step
    return how(done[: len(done) - rest], done[rest:]) if rest else done


def minimisers(prefix: np.ndarray, inside: np.ndarray, per_window: int) -> np.ndarray:
    """Places whose prefix hash is the smallest of some window of ``per_window`` places;
    ``inside`` tells which windows lie in one document."""
    least = sliding(prefix, per_window, np.minimum)
    least = np.where(inside, least, np.uint64(0))
    pad = np.zeros(per_window - 1, np.uint64)
    best = sliding(np.concatenate((pad, least, pad)), per_window, np.maximum)
    return np.flatnonzero((best == prefix) & (best > 0))


def _decide(level: int, keys, owner, *more):
    if level == EXTENDED:
        return B.per_key(keys, more[0]) < more[0], ()
    return (B.per_key(keys, np.ones(len(keys), np.int64), np.add) > 1) | (B.per_key(keys, more[0], np.maximum) > 0), ()


def suffix_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = 50,
    prefix_words: int = 25,
    chunk: int | None = None,
    per_bucket: int | None = None,
) -> DataFrame:
    """Per row of ``docs``: ``row`` (its other columns), ``text`` (without the repeats),
    ``n_words``, ``n_removed``, ``removed`` (spans of word numbers)."""
    if not 0 < prefix_words <= min_words:
        raise ValueError("prefix_words must be in 1..min_words")
    ship_package(docs.sparkSession)
    dealt, layout = B.chunked(docs, id_col, text_col, chunk, per_bucket)
    per_window = min_words - prefix_words + 1

    def read(table: pa.Table):
        data, offsets = B.texts(table["_text"])
        return (data, offsets, *W.words(data, offsets), B.ordered_ids(table["_id"]))

    def retained(rows: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        prefix = W.windows(h, prefix_words)
        at = minimisers(prefix, W.within(rows, min_words), per_window) if len(rows) >= min_words else np.zeros(0, np.int64)
        # minimisers are small hashes: mixed once more, they spread evenly over the buckets
        return at, W.mix(prefix[at] ^ W.START)

    def suffixes(table: pa.Table) -> pa.Table:
        _, _, rows, _, _, h, ids = read(table)
        at, prefix = retained(rows, h)
        keys, _, many = B.distinct_ids(prefix, ids[rows[at]])
        return B.to_table(B.blocks(table["_chunk"][0].as_py(), MATCHED, layout, keys, many))

    def extend(table: pa.Table, got: pa.Table) -> pa.Table:
        _, _, rows, _, _, h, ids = read(table)
        at, prefix = retained(rows, h)
        at = at[B.member(prefix, B.answered(got, MATCHED))]
        whole, inside = W.windows(h, min_words), W.within(rows, min_words)
        holds = W.cover(np.maximum(at - (per_window - 1), 0), len(h), per_window)[: len(whole)] & inside
        holds = np.flatnonzero(holds)
        keys, least, _ = B.distinct_ids(whole[holds], ids[rows[holds]])
        return B.to_table(B.blocks(table["_chunk"][0].as_py(), EXTENDED, layout, keys, least))

    def finish(table: pa.Table, got: pa.Table) -> pa.Table:
        data, offsets, rows, starts, _, h, ids = read(table)
        n = table.num_rows
        at = np.flatnonzero(W.within(rows, min_words))
        keys = W.windows(h, min_words)[at]
        own = ids[rows[at]]
        earlier = B.member(keys, B.answered(got, EXTENDED)) | (B.per_key(keys, own) < own)
        gone = W.cover(at[earlier], len(rows), min_words)
        stay = np.ones(len(data), bool)
        for a, b in zip(*W.runs(gone, rows)):  # from the first word to the next one that stays
            end = starts[b + 1] if b + 1 < len(rows) and rows[b + 1] == rows[b] else offsets[rows[b] + 1]
            stay[starts[a] : end] = False
        bounds = np.concatenate(([0], np.cumsum(stay)))[offsets]
        text = W.strings(data[stay], bounds)
        nulls = pa.compute.is_null(table["_text"])
        return pa.table(
            {
                "row": table["_rest"],
                "text": pa.compute.if_else(nulls, pa.scalar(None, pa.string()), text),
                "n_words": pa.array(W.per_row(np.ones(len(rows), bool), rows, n), pa.int64()),
                "n_removed": pa.array(W.per_row(gone, rows, n), pa.int64()),
                "removed": W.span_lists(gone, rows, n),
            }
        )

    grouped = dealt.groupBy("_chunk")
    matched = B.answer(grouped.applyInArrow(suffixes, B.BLOCK), _decide)
    sent = grouped.cogroup(matched.groupBy("_chunk")).applyInArrow(extend, B.BLOCK)
    back = B.answer(sent, _decide)
    schema = (
        T.StructType()
        .add("row", dealt.schema["_rest"].dataType)
        .add("text", "string")
        .add("n_words", "long")
        .add("n_removed", "long")
        .add("removed", B.SPANS)
    )
    return grouped.cogroup(back.groupBy("_chunk")).applyInArrow(finish, schema)


def op8_suffix_array_dedup(spark, sf_dir: str) -> DataFrame:
    """Repeats of 50 words or more over the whole of ``documents``."""
    out = suffix_dedup(table(spark, sf_dir, "documents"), min_words=50)
    return out.select("row.doc_id", "n_words", "n_removed", "removed", F.sha2("text", 256).alias("text_sha256"))
