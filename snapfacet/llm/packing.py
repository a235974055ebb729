"""Operator 4, harmonic packing of token sequences.

Documents are tokenized and an end id is added. What is as long as a sequence is cut off first; the rest of a
document, or a short document as it is, belongs to the reciprocal class of its length: class k has lengths over
capacity / (k + 1) and up to capacity / k, so that k of them always fit into one sequence.

Each task fills the sequences of each class with the class's fixed number of documents, without regard to
other tasks. The gap that they leave is shorter than any other piece of the class: where it is over one 128th of a sequence, it is filled with the
beginning of one more piece of the class, whose rest goes on in the class of its own length. So a full sequence of class k holds k
whole pieces and one beginning, and pads less than a 128th; a document is rarely cut twice. What a task has left over of its classes
(fewer pieces than fill a sequence) is packed once more: a group of ``fold`` tasks puts its left-over pieces one after the other into
sequences, cutting where one is full, so the group pads one sequence only.

Tokenizing is by word: a text's ids are those of its white-space-parted words, and a letter run
and the punctuation beside it never merge, so each distinct unit of a batch is tokenized once (and
kept for the next batches, up to a bound) and the rest is array gathering.

Defined results: a null or empty text is one piece with the end id; a repeated row is packed as
often as it is there; ids may be null or of any integer type; an empty table gives no pieces.
Other columns, whatever their names, are in ``row``.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir, ship_package, table
from . import blocks as B
from . import words as W

#: Units kept per worker, and bytes of text tokenized at once.
CACHE, BATCH = 600_000, 4 << 20
#: A gap of at most one part of so many of a sequence is padded.
SMALL = 128
_APOSTROPHE, _ZERO = 39, ord("0")
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
#: Printable ASCII that is neither a letter nor an apostrophe.
_SIGN = np.zeros(256, bool)
_SIGN[33:127] = True
_SIGN &= ~_LETTER
_SIGN[_APOSTROPHE] = False


class WordTokenizer:
    """Token ids of texts by way of their distinct units; equal to encoding the whole text for
    tokenizers that drop white space and part letters from punctuation, as the one used does."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.zero = self._encode(["0"])[0]
        self._forget()

    def _forget(self) -> None:
        """Known units: their sorted hashes, and where their ids lie in ``flat``."""
        self.units, self.first, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_units(self, units: list[bytes], plain: bool) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all units, number of ids of each). Plain units have no digit 0: they are
        encoded many at a time with a 0, which is always a token of its own, between them."""
        ids, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for s in range(0, len(units), 512):
            some = units[s : s + 512]
            if plain and len(self.zero) == 1:
                got = np.array(self._encode([b" 0 ".join(some).decode()])[0], np.uint32)
                cut = np.flatnonzero(got == self.zero[0])
                if len(cut) == len(some) - 1:
                    ids.append(np.delete(got, cut))
                    sizes.append(np.diff(np.concatenate(([-1], cut, [len(got)]))) - 1)
                    continue
            got = self._encode([u.decode() for u in some])
            ids.append(np.array([i for g in got for i in g], np.uint32))
            sizes.append(np.array([len(g) for g in got], np.int64))
        return np.concatenate(ids), np.concatenate(sizes)

    def _learn(self, data: np.ndarray, unit: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Make all of the distinct units known."""
        new = np.flatnonzero(~B.member(unit, self.units))
        if len(self.units) + len(new) > CACHE:
            self._forget()
            new = np.arange(len(unit))
        if not len(new):
            return
        zeros = np.concatenate(([0], np.cumsum(data == _ZERO)))
        pairs = np.concatenate(([0], np.cumsum(np.append((data[:-1] == 60) & (data[1:] == 124), False))))
        odd = (zeros[ends[new]] > zeros[starts[new]]) | (pairs[ends[new]] > pairs[starts[new]])
        raw = data.tobytes()
        for some, plain in ((new[~odd], True), (new[odd], False)):
            ids, size = self._encode_units([raw[a:b] for a, b in zip(starts[some].tolist(), ends[some].tolist())], plain)
            first = len(self.flat) + np.cumsum(size) - size
            self.flat = np.concatenate((self.flat, ids))
            at = np.searchsorted(self.units, unit[some])
            self.units = np.insert(self.units, at, unit[some])
            self.first, self.size = np.insert(self.first, at, first), np.insert(self.size, at, size)

    def __call__(self, data: np.ndarray, offsets: np.ndarray):
        """(ids of all rows, tokens before each row)."""
        rows, starts, ends, _ = W.words(data, offsets, hashes=False)
        rows, starts, ends = _parted(data, rows, starts, ends)
        h = np.zeros(len(starts), np.uint64)
        for a in range(0, len(starts), 1 << 18):
            b = min(len(starts), a + (1 << 18))
            lo, hi = int(starts[a]), int(ends[b - 1])
            # by their bytes as they are: a special token is known by its case
            h[a:b] = W._hash(data[lo:hi], starts[a:b] - lo, ends[a:b] - lo)
        unit, place = np.unique(h, return_index=True)
        self._learn(data, unit, starts[place], ends[place])
        at = np.searchsorted(self.units, h)
        n, first = self.size[at], self.first[at]
        before = np.concatenate(([0], np.cumsum(n)))
        ids = self.flat[np.repeat(first - before[:-1], n) + np.arange(before[-1])]
        return ids, before[np.searchsorted(rows, np.arange(len(offsets)), "left")]


def _parted(data: np.ndarray, rows: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """The words, parted where an ASCII letter and a sign stand side by side; words that may
    hold a special token (``<|``) stay whole."""
    kind = _LETTER[data].astype(np.int8) - _SIGN[data]
    edge = np.flatnonzero(kind[1:] * kind[:-1] == -1) + 1
    if not len(edge):
        return rows, starts, ends
    of = np.searchsorted(starts, edge, "right") - 1
    whole = np.zeros(len(starts), bool)
    whole[np.searchsorted(starts, np.flatnonzero((data[:-1] == 60) & (data[1:] == 124)), "right") - 1] = True
    inside = ~whole[of] & (edge < ends[of]) & (edge > starts[of])
    edge, of = edge[inside], of[inside]
    order = np.argsort(np.concatenate((starts, edge)), kind="stable")
    cut = np.concatenate((np.zeros(len(starts), bool), np.ones(len(edge), bool)))[order]
    rows, begin, end = (np.concatenate((x, y))[order] for x, y in ((rows, rows[of]), (starts, edge), (ends, ends[of])))
    end[:-1] = np.where(cut[1:], begin[1:], end[:-1])
    return rows, begin, end


_TOKENIZERS: dict[str, WordTokenizer] = {}


def _tokenizer(name: str) -> WordTokenizer:
    """The tokenizer of a worker, with the units it knows from earlier tasks."""
    if name not in _TOKENIZERS:
        file = name
        if not os.path.isabs(name):
            from public_tokenizers import path

            file = path(name)
        _TOKENIZERS[name] = WordTokenizer(file)
    return _TOKENIZERS[name]


def class_of(length: int, capacity: int) -> int:
    """The reciprocal class of a piece: so many of its length fit into a sequence."""
    return capacity // length


COLUMNS = ("row", "start", "length", "ids_crc32", "doc_tokens", "class", "sequence_id", "offset", "task", "ids")
#: Numbers of sequences of one task, or of one group of tasks; groups count from GROUP.
TASK, GROUP = 1 << 32, 1 << 62


def _schema(row: T.DataType) -> T.StructType:
    kinds = ("long", "long", "long", "long", "integer", "long", "long", "long", "binary")
    out = T.StructType().add("row", row)
    for name, kind in zip(COLUMNS[1:], kinds):
        out = out.add(name, kind)
    return out


class _Piece:
    __slots__ = ("row", "start", "total", "ids")

    def __init__(self, row: int, start: int, total: int, ids: bytes):
        self.row, self.start, self.total, self.ids = row, start, total, ids

    def __len__(self) -> int:
        return len(self.ids) // 4


class _Filling:
    """The open pieces of a task: of each class k at most k, or k + 1 beside each other."""

    def __init__(self, task: int, capacity: int):
        self.task, self.capacity, self.used = task, capacity, 0
        self.open: dict[int, list[_Piece]] = {}
        self.rows, self.out = None, []

    def add(self, rows: pa.Array, pieces: list[_Piece]) -> pa.Table | None:
        """The pieces of sequences that are now full; the others stay here. The pieces' ``row`` is a place in ``rows``."""
        if self.rows is not None:
            for p in pieces:
                p.row += len(self.rows)
            rows = pa.concat_arrays([self.rows, rows])
        for p in pieces:
            self._put(p)
        out, self.out = self.out, []
        table = self._table(rows, out) if out else None
        # of the rows, keep what open pieces need
        held = [p for queue in self.open.values() for p in queue]
        places, number = np.unique(np.array([p.row for p in held], np.int64), return_inverse=True)
        for p, n in zip(held, number.tolist()):
            p.row = n
        self.rows = rows.take(pa.array(places, pa.int64()))
        return table

    def _put(self, piece: _Piece) -> None:
        todo = [piece]
        while todo:
            p = todo.pop()
            k = class_of(len(p), self.capacity)
            queue = self.open.setdefault(k, [])
            queue.append(p)
            if len(queue) < k:
                continue
            gap = self.capacity - sum(map(len, queue[:k]))
            if gap <= self.capacity // SMALL:
                self._fill(k, queue[:k])
                del queue[:k]
            elif len(queue) > k:  # the longest is cut, so that its rest is not short
                cut = queue.pop(max(range(k + 1), key=lambda i: len(queue[i])))
                gap = self.capacity - sum(map(len, queue))
                begin = _Piece(cut.row, cut.start, cut.total, cut.ids[: 4 * gap])
                self._fill(k, [*queue, begin] if gap else queue)
                queue.clear()
                if gap < len(cut):
                    todo.append(_Piece(cut.row, cut.start + gap, cut.total, cut.ids[4 * gap :]))

    def _fill(self, k: int, pieces: list[_Piece]) -> None:
        place, number = 0, self.task * TASK + self.used
        for p in pieces:
            self.out.append((p, k, number, place))
            place += len(p)
        self.used += 1

    def _table(self, rows: pa.Array, placed: list, ids: bool = False) -> pa.Table:
        pieces = [p for p, _, _, _ in placed]
        longs = lambda values: pa.array(list(values), pa.int64())
        cols = [
            rows.take(longs(p.row for p in pieces)),
            longs(p.start for p in pieces),
            longs(len(p) for p in pieces),
            longs(zlib.crc32(p.ids) for p in pieces),
            longs(p.total for p in pieces),
            pa.array([k for _, k, _, _ in placed], pa.int32()),
            longs(n for _, _, n, _ in placed),
            longs(o for _, _, _, o in placed),
            pa.array(np.full(len(placed), self.task), pa.int64()),
            pa.array([p.ids for p in pieces], pa.binary()) if ids else pa.nulls(len(placed), pa.binary()),
        ]
        return pa.table(cols, names=COLUMNS)

    def left(self) -> pa.Table | None:
        """The open pieces, with their ids."""
        held = [(p, k, None, None) for k, queue in sorted(self.open.items()) for p in queue]
        return self._table(self.rows, held, ids=True) if held else None


def pack_full(docs: DataFrame, tokenizer: str, text_col: str, capacity: int, end_id: int) -> DataFrame:
    """Tokenize, cut and fill: one row per piece; pieces of sequences that the task could not
    fill have no ``sequence_id`` but their ``ids``."""
    ship_package(docs.sparkSession)
    end = np.array([end_id], np.uint32)

    def run(batches):
        encode, filling = _tokenizer(tokenizer), _Filling(TaskContext.get().partitionId(), capacity)
        for batch in batches:
            data, offsets = W.text_bytes(batch.column("_text"))
            for a, b in W.slices(offsets, BATCH):
                lo, hi = int(offsets[a]), int(offsets[b])
                ids, at = encode(data[lo:hi], offsets[a : b + 1] - lo)
                pieces = []
                for i in range(b - a):
                    mine = np.concatenate((ids[at[i] : at[i + 1]], end)).astype("<u4").tobytes()
                    total = len(mine) // 4
                    for start in range(0, total, capacity):
                        pieces.append(_Piece(a + i, start, total, mine[4 * start : 4 * (start + capacity)]))
                full = filling.add(batch.column("row"), pieces)
                if full is not None:
                    yield from full.combine_chunks().to_batches()
        if (left := filling.left()) is not None:
            yield from left.to_batches()

    row = F.struct(*(B.quoted(c) for c in docs.columns if c != text_col))
    d = docs.select(row.alias("row"), B.quoted(text_col).cast("string").alias("_text"))
    return d.mapInArrow(run, _schema(d.schema["row"].dataType))


def _pack_left(table: pa.Table, capacity: int, first: int) -> pa.Table:
    """Left-over pieces one after the other, the long ones first, cut where a sequence ends."""
    length, task = table["length"].to_numpy(), table["task"].to_numpy()
    order = np.lexsort((table["start"].to_numpy(), task, -length))
    place, index, out = 0, [], []
    start, total, kind = (table[c].to_numpy() for c in ("start", "doc_tokens", "class"))
    ids = table["ids"]
    for i in order.tolist():
        raw, done = ids[i].as_py(), 0
        while done < length[i]:
            n = min(int(length[i]) - done, capacity - place % capacity)
            part = raw[4 * done : 4 * (done + n)]
            out.append((int(start[i]) + done, n, zlib.crc32(part), int(total[i]), int(kind[i]), first + place // capacity, place % capacity, int(task[i]), None))
            index.append(i)
            done, place = done + n, place + n
    types = [pa.int64()] * 4 + [pa.int32()] + [pa.int64()] * 3 + [pa.binary()]
    cols = [pa.array(c, t) for c, t in zip(zip(*out), types)]
    return pa.table([table["row"].combine_chunks().take(pa.array(index, pa.int64())), *cols], names=COLUMNS)


def pack(
    docs: DataFrame,
    text_col: str = "text",
    tokenizer: str = "word_bpe_49k.json",
    capacity: int = 2048,
    end_id: int = 1,
    fold: int = 4,
) -> DataFrame:
    """One row per piece: ``row`` (the document's other columns), ``start``, ``length``,
    ``ids_crc32``, ``doc_tokens``, ``class``, ``sequence_id`` and ``offset``. ``tokenizer`` is a
    path or the name of a public vocabulary file."""
    ensure_checkpoint_dir(docs.sparkSession)
    pieces = pack_full(docs, tokenizer, text_col, capacity, end_id).checkpoint()
    group = (F.col("task") / fold).cast("long")

    def fill(key, table):
        return _pack_left(table, capacity, GROUP + key[0].as_py() * TASK)

    left = pieces.where("sequence_id IS NULL").groupBy(group.alias("_group")).applyInArrow(fill, pieces.schema)
    return pieces.where("sequence_id IS NOT NULL").unionByName(left).drop("task", "ids")


def op4_harmonic_packing(spark, sf_dir: str) -> DataFrame:
    """Contract query: sequences of 2048 tokens, whole ``documents``."""
    out = pack(table(spark, sf_dir, "documents"))
    return out.select("row.doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "class")
