"""Operator 1, substring dedup by level-wise doubling.

A passage of ``min_words`` words is removed from a document when a document with a smaller id
has it too. The windows of a first, shorter length are compared over the whole corpus; only
windows that repeat at one length are extended to twice that length (to ``min_words`` at the
last step), so the many windows that occur in one document alone are given up at the first
level. The doubling ends at ``min_words``, where the survivors decide what is removed: every
longer repeat is made of windows of that length. A level without survivors sends nothing.

A level sends the distinct windows of each chunk as packed keys (``blocks``): before the last
level about 32 bits a key beyond the bucket's number, enough to give up all but one in some
thousand of the unique windows at any corpus size; at the last level 64 bits and the smallest
id. What a bucket answers is for a chunk only, so a passage held by a third of all documents
costs one key per chunk and window.

Defined results: a null text has no words; a null id comes before all others; documents with
equal ids don't take words from each other; a repeated row is returned as often as it is there;
an empty table gives an empty result. Other columns of the input, whatever their names, are
handed on in ``row``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package
from . import blocks as B
from . import words as W

SPARE = 32


def lengths(min_words: int, first: int) -> list[int]:
    """The window lengths of the levels: each at most twice the one before."""
    out = [min_words]
    while math.ceil(out[0] / 2) >= first:
        out.insert(0, math.ceil(out[0] / 2))
    return out


def _read(table: pa.Table):
    data, offsets = B.texts(table["_text"])
    return (data, *W.words(data, offsets), B.ordered_ids(table["_id"]))


def _keys(h: np.ndarray, rows: np.ndarray, k: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Key of each window of k words and whether it stays in its row."""
    return W.windows(h, k) >> np.uint64(64 - bits), W.within(rows, k)


def _decide(level: int, keys, owner, *more):
    if len(more) == 2:  # last level: smallest id of each chunk; the flag is not needed
        least = B.per_key(keys, more[0])
        return least < more[0], ()
    many = B.per_key(keys, np.ones(len(keys), np.int64), np.add) > 1
    return many | (B.per_key(keys, more[0], np.maximum) > 0), ()


def substring_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = 13,
    first_words: int = 6,
    chunk: int | None = None,
    per_bucket: int | None = None,
) -> DataFrame:
    """Per row of ``docs``: ``row`` (its other columns), ``n_words``, ``n_removed``, ``removed``
    (spans of word numbers) and ``kept`` (the words that stay, joined by one space)."""
    ship_package(docs.sparkSession)
    dealt, layout = B.chunked(docs, id_col, text_col, chunk, per_bucket)
    levels = lengths(min_words, first_words)
    narrow = min(64, SPARE + layout.buckets.bit_length())

    def send(level: int, table: pa.Table, got: pa.Table | None = None) -> pa.Table:
        _, rows, _, _, h, ids = _read(table)
        k, last = levels[level], level == len(levels) - 1
        bits = 64 if last else narrow
        keys, ok = _keys(h, rows, k, bits)
        if got is not None:  # both halves must have repeated
            half = levels[level - 1]
            before, _ = _keys(h, rows, half, narrow)
            there = B.member(before, B.answered(got, level - 1))
            ok = ok & there[: len(ok)] & there[k - half : k - half + len(ok)]
        at = np.flatnonzero(ok)
        keys, least, many = B.distinct_ids(keys[at], ids[rows[at]])
        more = (least, many) if last else (many,)
        return B.to_table(B.blocks(table["_chunk"][0].as_py(), level, layout, keys, *more, bits=bits))

    grouped = dealt.groupBy("_chunk")
    def extend(level: int):
        return lambda table, got: send(level, table, got)

    back = B.answer(grouped.applyInArrow(lambda table: send(0, table), B.BLOCK), _decide)
    for level in range(1, len(levels)):
        sent = grouped.cogroup(back.groupBy("_chunk")).applyInArrow(extend(level), B.BLOCK)
        back = B.answer(sent, _decide)

    def finish(table: pa.Table, got: pa.Table) -> pa.Table:
        data, rows, starts, ends, h, ids = _read(table)
        n = table.num_rows
        keys, ok = _keys(h, rows, min_words, 64)
        at = np.flatnonzero(ok)
        keys, own = keys[at], ids[rows[at]]
        earlier = B.member(keys, B.answered(got, len(levels) - 1)) | (B.per_key(keys, own) < own)
        gone = W.cover(at[earlier], len(rows), min_words)
        stay = ~gone
        return pa.table(
            {
                "row": table["_rest"],
                "n_words": pa.array(W.per_row(np.ones(len(rows), bool), rows, n), pa.int64()),
                "n_removed": pa.array(W.per_row(gone, rows, n), pa.int64()),
                "removed": W.span_lists(gone, rows, n),
                "kept": W.joined(data, rows[stay], starts[stay], ends[stay], n),
            }
        )

    schema = (
        T.StructType()
        .add("row", dealt.schema["_rest"].dataType)
        .add("n_words", "long")
        .add("n_removed", "long")
        .add("removed", B.SPANS)
        .add("kept", "string")
    )
    return grouped.cogroup(back.groupBy("_chunk")).applyInArrow(finish, schema)


def op1_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Contract query: 13 words, whole ``documents``."""
    from ..session import table

    out = substring_dedup(table(spark, sf_dir, "documents"), min_words=13)
    return out.select("row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"), F.size("removed").alias("n_spans"))
