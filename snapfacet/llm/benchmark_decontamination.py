"""Operator 7, benchmark decontamination with a generalised suffix automaton.

The normalised test items make one suffix automaton (a block of items at a time, see below).
Documents are streamed through it: at each token the automaton gives the longest suffix of what
was read that occurs in some item. Where that is a window's length or more, the window occurs:
its words are hit, and the state tells the items that hold it. An item shorter than a window is
a window itself; the nearest such item on the suffix links of a state is kept with the state.

The item table is a stated query set. It is read in blocks of at most ``block_words`` words (or
one item); an automaton has at most two states a word, so what is broadcast has a proven bound.
A larger table takes one pass over the documents for each block, and each pass adds to the spans
and items of the one before. Only runs of known words as long as the shortest window are
streamed: an unknown word leads to the start.

Defined results: null has no words; an item without words has no window; equal item ids are one
item; a document row is judged by itself, as often as it is there; an item with a null id marks
words but is not counted or named; empty tables give an empty result or no hits. Other
columns, whatever their names, are in ``row``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir, ship_package, table
from . import blocks as B
from . import words as W

class SuffixAutomaton:
    """Generalised suffix automaton of word-number sequences, with what a window match means:
    ``items[s]`` lists the items that hold the window which ends in state s."""

    def __init__(self, items: list[np.ndarray], window: int):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for words in items:
            last = 0
            for w in words.tolist():
                last = self._extend(last, w)
        n = len(self.next)
        #: (length, state above which a full window lies) -> item numbers
        self.items: list[set[int]] = [set() for _ in range(n)]
        self.short: list[dict[int, set[int]]] = [{} for _ in range(n)]
        for number, words in enumerate(items):
            state, size = 0, 0
            for w in words.tolist():
                state, size = self.next[state][w], size + 1
                if size >= window:
                    state = self._cut(state)
                    self.items[state].add(number)
                    size = min(size, window)
            if 0 < len(words) < window:
                self.short[state].setdefault(len(words), set()).add(number)
        # nearest state on the suffix links, itself included, that ends a short item
        self.ends = [-1] * n
        for s in sorted(range(n), key=self.length.__getitem__):
            self.ends[s] = s if self.short[s] else (self.ends[self.link[s]] if s else -1)

    def _cut(self, state: int) -> int:
        """The state of the last ``window`` words, from a state of at least as many."""
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def _extend(self, last: int, w: int) -> int:
        if w in self.next[last]:  # the words up to here are known from an earlier item
            q = self.next[last][w]
            return q if self.length[q] == self.length[last] + 1 else self._clone(last, w, q)
        new = self._state({}, self.length[last] + 1)
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._clone(p, w, q)
        else:
            self.link[new] = 0
        return new

    def _state(self, to: dict[int, int], length: int) -> int:
        self.next.append(to)
        self.link.append(0)
        self.length.append(length)
        return len(self.next) - 1

    def _clone(self, p: int, w: int, q: int) -> int:
        copy = self._state(dict(self.next[q]), self.length[p] + 1)
        self.link[copy], self.link[q] = self.link[q], copy
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        return copy

    def stream(self, words: list[int]):
        """(places one past the end of a match, their lengths, items) of a run of words."""
        state, size, found, items = 0, 0, [], set()
        nexts, link, length, window = self.next, self.link, self.length, self.window
        for i, w in enumerate(words):
            while state and w not in nexts[state]:
                state = link[state]
                size = length[state]
            to = nexts[state].get(w)
            if to is None:
                continue
            state, size = to, size + 1
            if size >= window:
                full = self._cut(state)
                found.append((i + 1, window))
                items |= self.items[full]
            s = self.ends[state]
            while s >= 0:
                for n, who in self.short[s].items():
                    if n <= size:
                        found.append((i + 1, n))
                        items |= who
                s = self.ends[link[s]] if s else -1
        return found, items

class Block:
    """The automaton of some items with their words and ids, ready to be broadcast."""

    def __init__(self, items: list[tuple[object, np.ndarray]], window: int):
        self.ids = [i for i, _ in items]
        h = [x for _, x in items]
        self.words = np.unique(np.concatenate(h)) if h else np.zeros(0, np.uint64)
        self.shortest = min((min(window, len(x)) for x in h), default=0)
        self.automaton = SuffixAutomaton([np.searchsorted(self.words, x) for x in h], window)

    def search(self, rows: np.ndarray, h: np.ndarray, hit: np.ndarray, items: dict[int, set]) -> None:
        """Mark the hit words and add each row's items."""
        if not len(self.words) or not len(h):
            return
        number = np.searchsorted(self.words, h)
        number[number == len(self.words)] = 0
        known = self.words[number] == h
        for a, b in zip(*W.runs(known, rows)):
            if b + 1 - a < self.shortest:
                continue
            found, who = self.automaton.stream(number[a : b + 1].tolist())
            for end, n in found:
                hit[a + end - n : a + end] = True
            if who:
                items.setdefault(int(rows[a]), set()).update(self.ids[i] for i in who if self.ids[i] is not None)

def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, window: int, block_words: int):
    """The blocks of the item table, read to the driver one partition at a time."""
    items = benchmark.select(B.quoted(id_col).cast("string").alias("i"), B.quoted(text_col).cast("string").alias("t"))
    some, size = [], 0
    for row in items.toLocalIterator():
        data, offsets = W.text_bytes(pa.array([row["t"]], pa.string()))
        h = W.words(data, offsets, W.ALNUM, W.LOWER)[3]
        if not len(h):
            continue
        if size and size + len(h) > block_words:
            yield Block(some, window)
            some, size = [], 0
        some.append((row["i"], h))
        size += len(h)
    if some:
        yield Block(some, window)

def _search(docs: DataFrame, block: Block, schema: T.StructType) -> DataFrame:
    """One pass: add a block's matches to the spans and items of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(block)

    def run(batches):
        for batch in batches:
            data, offsets = W.text_bytes(batch.column("text"))
            before, named = batch.column("spans").to_pylist(), batch.column("items").to_pylist()
            parts = []
            for a, b in W.slices(offsets):
                lo, hi = int(offsets[a]), int(offsets[b])
                part, at = data[lo:hi], offsets[a : b + 1] - lo
                rows, starts, ends, h = W.words(part, at, W.ALNUM, W.LOWER)
                hit, n = np.zeros(len(h), bool), b - a
                items = {r: set(named[a + r]) for r in range(n) if named[a + r]}
                base = np.searchsorted(rows, np.arange(n), "left")
                for r in range(n):
                    for span in before[a + r]:
                        hit[base[r] + span["start"] : base[r] + span["end"]] = True
                shared.value.search(rows, h, hit, items)
                stay = np.ones(len(part), bool)
                for x, y in zip(*W.runs(hit, rows)):
                    stay[starts[x] : ends[y]] = False
                bounds = np.concatenate(([0], np.cumsum(stay)))[at]
                ids = [sorted(items.get(r, ())) for r in range(n)]
                parts.append(
                    (
                        pa.array(W.per_row(np.ones(len(h), bool), rows, n), pa.int64()),
                        pa.array(W.per_row(hit, rows, n), pa.int64()),
                        pa.array(ids, pa.list_(pa.string())),
                        pa.array([len(i) for i in ids], pa.int64()),
                        W.span_lists(hit, rows, n),
                        W.strings(part[stay], bounds),
                    )
                )
            if parts:
                cols = [pa.concat_arrays(c) for c in zip(*parts)]
                cols[-1] = pa.compute.if_else(pa.compute.is_null(batch.column("text")), pa.scalar(None, pa.string()), cols[-1])
                yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("text"), *cols], schema.names)

    return docs.select("row", "text", "spans", "items").mapInArrow(run, schema)


def find_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "item_id",
    item_text: str = "text",
    text_col: str = "text",
    window: int = 13,
    block_words: int = 1_000_000,
) -> DataFrame:
    """Per row of ``docs``: ``row`` (its other columns), ``text``, ``n_words``, ``n_hit``,
    ``items`` (ids, as sorted strings), ``n_items``, ``spans`` (word numbers of the hit runs) and
    ``clean`` (the text without them)."""
    ship_package(docs.sparkSession)
    row = F.struct(*(B.quoted(c) for c in docs.columns if c != text_col))
    none = (F.array().cast(B.SPANS).alias("spans"), F.array().cast("array<string>").alias("items"))
    out = docs.select(row.alias("row"), B.quoted(text_col).cast("string").alias("text"), *none)
    schema = T.StructType().add("row", out.schema["row"].dataType).add("text", "string").add("n_words", "long").add("n_hit", "long")
    schema = schema.add("items", T.ArrayType(T.StringType())).add("n_items", "long").add("spans", B.SPANS).add("clean", "string")
    passes = 0
    for block in item_blocks(benchmark, id_col, item_text, window, block_words):
        if passes:  # one automaton at a time: the pass before is written first
            ensure_checkpoint_dir(docs.sparkSession)
            out = out.checkpoint()
        out, passes = _search(out, block, schema), passes + 1
    return out if passes else _search(out, Block([], window), schema)


def contaminated(min_share: float = 0.05):
    """The coverage limit: at least that share of a document's words is hit."""
    per = round(1 / min_share)
    return (F.col("n_hit") > 0) & (per * F.col("n_hit") >= F.col("n_words"))

def decontaminate(docs: DataFrame, benchmark: DataFrame, min_share: float = 0.05, min_span: int | None = None, **kw) -> DataFrame:
    """``row`` and ``text`` of the documents that stay. Documents at or over the coverage limit
    go; with ``min_span`` hit runs of at least so many words are taken out of the others."""
    found = find_benchmark(docs, benchmark, **kw).where(~contaminated(min_share))
    if min_span is None:
        return found.select("row", "text")
    long_run = F.exists("spans", lambda s: s["end"] - s["start"] >= min_span)
    return found.select("row", F.when(long_run, F.col("clean")).otherwise(F.col("text")).alias("text"))

def op7_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    """Contract query: windows of 13 words, whole ``documents`` against whole ``benchmark``."""
    found = find_benchmark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ","), 256)
    return found.select("row.doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), contaminated().alias("contaminated"))
