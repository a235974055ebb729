"""Key exchange between chunks of documents: packed, sorted keys instead of a row per window.

Documents are dealt into chunks of about ``CHUNK`` bytes by a hash of id and text. Inside a
chunk the keys of all windows (or n-grams) are sorted and made distinct, so that a passage
that is frequent in the corpus sends one key per chunk, not one per occurrence. The distinct
keys go to buckets by range: one row (chunk, bucket, packed keys) each. A bucket's task sees
every chunk's keys of its range, decides, and answers each chunk; the chunk, its documents and
its answers meet again in a co-group.

A chunk holds ``CHUNK`` bytes or one document, and buckets are as many as the input needs for
about ``PER_BUCKET`` keys each. A block is a chunk's share of a bucket, so with fixed sizes there
would be ever more blocks of ever fewer keys; both sizes therefore grow with the square root of the
input above ``EVEN`` bytes, up to bounds that a task's memory sets (about 1 GB at either bound).
"""

from __future__ import annotations

import math
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK = 2 << 20
PER_BUCKET = 1_500_000
EVEN, LARGEST_CHUNK, LARGEST_BUCKET = 1 << 30, 64 << 20, 24_000_000
SPANS = T.ArrayType(T.StructType().add("start", "long").add("end", "long"))
BLOCK = "_chunk long, _bucket long, _level int, _block binary"


def pack(*arrays: np.ndarray, level: int = 1) -> bytes:
    """Unsigned arrays as compressed byte planes (only as many planes as the largest needs)."""
    out = [struct.pack("<I", len(arrays))]
    for a in arrays:
        a = np.ascontiguousarray(a, dtype="<u8")
        width = max(1, (int(a.max()).bit_length() + 7) // 8) if len(a) else 0
        out.append(struct.pack("<QB", len(a), width))
        out.append(a.view(np.uint8).reshape(len(a), 8)[:, :width].T.tobytes())
    raw = b"".join(out)
    return struct.pack("<Q", len(raw)) + pa.Codec("zstd", level).compress(raw, asbytes=True)


def unpack(block: bytes) -> list[np.ndarray]:
    (size,) = struct.unpack_from("<Q", block)
    raw = pa.decompress(block[8:], decompressed_size=size, codec="zstd", asbytes=True)
    (count,) = struct.unpack_from("<I", raw)
    at, out = 4, []
    for _ in range(count):
        n, width = struct.unpack_from("<QB", raw, at)
        at += 9
        a = np.zeros((n, 8), np.uint8)
        if n:
            a[:, :width] = np.frombuffer(raw, np.uint8, n * width, at).reshape(width, n).T
        out.append(a.view("<u8").reshape(n))
        at += n * width
    return out


def delta(keys: np.ndarray) -> np.ndarray:
    """Differences of sorted keys."""
    out = keys.copy()
    out[1:] -= keys[:-1]
    return out


def quoted(name: str):
    """A column by its name as it is, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


class Layout:
    """How many chunks and buckets an input takes (from one pass that sums text lengths)."""

    def __init__(self, total_bytes: int, chunk: int | None = None, per_bucket: int | None = None):
        grown = max(1.0, math.sqrt(total_bytes / EVEN))
        self.words = max(1, total_bytes // 5)
        self.chunks = max(1, math.ceil(total_bytes / min(LARGEST_CHUNK, (chunk or CHUNK) * grown)))
        self.buckets = max(1, math.ceil(self.words / min(LARGEST_BUCKET, (per_bucket or PER_BUCKET) * grown)))

    def bits(self, spare: int) -> int:
        """Bits of a key for which two different keys are equal with a chance under 2**-spare."""
        return min(64, self.words.bit_length() + spare)


def chunked(docs: DataFrame, id_col: str, text_col: str, chunk: int | None = None, per_bucket: int | None = None):
    """(documents as _id, _text, _rest with their _chunk, dealt by chunk; layout). ``_rest``
    holds all columns of ``docs`` as they are, but for the text."""
    text = quoted(text_col).cast("string")
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    layout = Layout(total, chunk, per_bucket)
    rest = F.struct(*(quoted(c) for c in docs.columns if c != text_col))
    d = docs.select(quoted(id_col).cast("long").alias("_id"), text.alias("_text"), rest.alias("_rest"))
    d = d.withColumn("_chunk", F.pmod(F.xxhash64("_id", "_text"), F.lit(layout.chunks)))
    packed = T.StructType([T.StructField(f.name, T.BinaryType() if f.name == "_text" else f.dataType) for f in d.schema])
    return d.mapInArrow(_packed_texts, packed).repartition("_chunk"), layout


def _packed_texts(batches):
    """Texts as zstd frames behind their length: the dealt documents are the largest shuffle, and
    the block compression of the shuffle makes them half as large again."""
    codec = pa.Codec("zstd", 1)
    for batch in batches:
        out = []
        for text in batch.column("_text"):
            raw = text.as_buffer() if text.is_valid else None
            out.append(None if raw is None else struct.pack("<Q", raw.size) + (codec.compress(raw, asbytes=True) if raw.size else b""))
        i = batch.schema.get_field_index("_text")
        cols = [*batch.columns[:i], pa.array(out, pa.binary()), *batch.columns[i + 1 :]]
        yield pa.RecordBatch.from_arrays(cols, batch.schema.names)


def texts(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of packed texts (null: empty)."""
    codec, parts, size = pa.Codec("zstd"), [], [0]
    for value in column:
        block = value.as_buffer() if value.is_valid else None
        n = struct.unpack_from("<Q", block)[0] if block is not None else 0
        if n:
            parts.append(codec.decompress(block[8:], n, asbytes=True))
        size.append(n)
    return np.frombuffer(b"".join(parts), np.uint8), np.cumsum(np.array(size, np.int64))


def blocks(chunk: int, level: int, layout: Layout, keys: np.ndarray, *more: np.ndarray, bits: int = 64):
    """Rows for the sorted, distinct ``keys`` (of ``bits`` bits) of one chunk."""
    edge = (np.arange(layout.buckets + 1, dtype=object) * (1 << bits)) // layout.buckets
    low = np.array([int(x) for x in edge[:-1]], dtype=np.uint64)
    cut = np.append(np.searchsorted(keys, low, "left"), len(keys))
    rows = []
    for b in range(layout.buckets):
        s = slice(cut[b], cut[b + 1])
        if s.start < s.stop:
            rows.append((chunk, b, level, pack(delta(keys[s]), *(m[s] for m in more))))
    return rows


def to_table(rows) -> pa.Table:
    cols = list(zip(*rows)) if rows else ((), (), (), ())
    types = (pa.int64(), pa.int64(), pa.int32(), pa.binary())
    names = ("_chunk", "_bucket", "_level", "_block")
    return pa.table([pa.array(c, t) for c, t in zip(cols, types)], names=names)


def answer(sent: DataFrame, decide) -> DataFrame:
    """Send every block to its bucket and answer it. ``decide(level, keys, owner, *more)`` gets
    all keys of a bucket and level and returns ``(mask or None, arrays)``: with a mask the answer
    of a block is its masked keys; without one it is the arrays, in the order of its keys."""

    def bucket(table: pa.Table) -> pa.Table:
        chunks, levels = table["_chunk"].to_pylist(), np.array(table["_level"].to_pylist())
        buckets, out = table["_bucket"].to_pylist(), []
        for level in np.unique(levels):
            at = np.flatnonzero(levels == level)
            got = [unpack(table["_block"][int(i)].as_py()) for i in at]
            keys = np.concatenate([np.cumsum(g[0], dtype=np.uint64) for g in got])
            sizes = [len(g[0]) for g in got]
            owner = np.repeat(np.arange(len(at)), sizes)
            more = [np.concatenate(x) for x in zip(*(g[1:] for g in got))] if len(got[0]) > 1 else []
            del got
            mask, arrays = decide(int(level), keys, owner, *more)
            end = np.cumsum([0, *sizes])
            for j, i in enumerate(at):
                s = slice(end[j], end[j + 1])
                if mask is None:
                    block = pack(*(a[s] for a in arrays), level=6)
                elif mask[s].any():
                    block = pack(delta(keys[s][mask[s]]))
                else:
                    continue
                out.append((chunks[i], buckets[i], int(level), block))
        return to_table(out)

    return sent.groupBy("_bucket").applyInArrow(bucket, BLOCK)


def groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sort order of the keys and the first place of each run of equal neighbours in it."""
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    new = np.ones(len(s), bool)
    new[1:] = s[1:] != s[:-1]
    return order, np.flatnonzero(new)


def per_key(keys: np.ndarray, values: np.ndarray, how=np.minimum) -> np.ndarray:
    """For each entry, ``how`` over the values of all entries with its key."""
    if not len(keys):
        return values
    order, first = groups(keys)
    best = how.reduceat(values[order], first)
    out = np.empty_like(values)
    out[order] = np.repeat(best, np.diff(np.append(first, len(keys))))
    return out


def distinct_ids(keys: np.ndarray, ids: np.ndarray):
    """(sorted distinct keys, smallest id of each, whether it has two different ids)."""
    if not len(keys):
        return keys, ids, np.zeros(0, bool)
    order, first = groups(keys)
    v = ids[order]
    low, high = np.minimum.reduceat(v, first), np.maximum.reduceat(v, first)
    return keys[order][first], low, low != high


def answered(table: pa.Table, level: int) -> np.ndarray:
    """The sorted keys that the buckets have sent back to a chunk at a level."""
    got = [
        (b, np.cumsum(unpack(x)[0], dtype=np.uint64))
        for b, lv, x in zip(table["_bucket"].to_pylist(), table["_level"].to_pylist(), table["_block"].to_pylist())
        if lv == level
    ]
    return np.concatenate([k for _, k in sorted(got, key=lambda g: g[0])]) if got else np.zeros(0, np.uint64)


def member(keys: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Whether each key is among the sorted keys."""
    if not len(among):
        return np.zeros(len(keys), bool)
    at = np.searchsorted(among, keys)
    at[at == len(among)] = 0
    return among[at] == keys


#: Ids are moved to unsigned numbers that keep their order; a null id comes before all others.
def ordered_ids(column) -> np.ndarray:
    ids = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    ids = ids.cast(pa.int64()).fill_null(-(2**63)).to_numpy(zero_copy_only=False)
    return ids.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)
