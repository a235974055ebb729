"""Operator 11, exact ranked lexical search by a dual-tree traversal.

Items (the stated query set) and documents are sparse vectors over the items' terms: an item's
coordinate is a term's weight times its count in the item, a document's is what one such unit
scores in it, and a score is their inner product, all in whole numbers. Both sides get a hierarchy.
A node holds the maximum of each coordinate below it, so the product of two nodes bounds every score
of an item below the one with a document below the other. The two trees are walked together; a pair of
nodes is given up, and with it a whole batch of scores, when its bound is under the weakest k-th score that any item
of its node has so far. Documents that may equal a k-th score are looked at, so ties are exact. Nodes of
high bounds come first, and an item's k best go on from one block of documents to the next.

One scan cuts the texts into terms and writes, for each slice of documents, their counts of the items'
terms (packed); corpus size, lengths and document frequencies are sums over that table. A second
pass walks the trees, a block of at most ``block_entries`` counts at a time, and answers with k rows
an item and task; these are merged first by salted, then by whole items.

The item table is read in blocks of at most ``block_terms`` (item, term) entries, or one item; so
what is broadcast, the terms and trees of one block, has a bound. A larger table takes two passes for each block.

Defined results: null and empty texts have no terms and are in no count and no ranking; an item
without terms has no rows; equal items are ranked each by itself; equal documents each have a rank; a null document id
comes after all others of its score; empty tables give an empty result. Other columns, whatever
their names, are not looked at.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, scratch, ship_package, table
from . import blocks as B
from . import words as W

LEAF, FAN = 32, 8
ITEM_LEAF, ITEM_FAN = 4, 4
ENTRIES, TERMS = 1_000_000, 1 << 18
SALTS = 64
#: Fixed numbers of the score: scale of a weight, of a document's share, and of its length.
WEIGHT, UNIT, SATURATION, LENGTH = 1000, 1_000_000_000, 1000, 12


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table of the shared folder."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# --- items --------------------------------------------------------------------------------------


def item_bags(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``item`` (a number fixed by the write), ``item_id`` and the packed terms and counts of each item."""
    rows = items.select(B.quoted(id_col).alias("item_id"), B.quoted(text_col).cast("string").alias("text"))
    rows = rows.withColumn("item", F.monotonically_increasing_id())

    def run(batches):
        for batch in batches:
            data, offsets = W.text_bytes(batch.column("text"))
            row, _, _, h = W.words(data, offsets, W.ALNUM, W.LOWER)
            cut = np.searchsorted(row, np.arange(batch.num_rows + 1), "left")
            bags = [np.unique(h[a:b], return_counts=True) for a, b in zip(cut[:-1], cut[1:])]
            packed = [B.pack(B.delta(t), c.astype(np.uint64)) if len(t) else None for t, c in bags]
            cols = [batch.column("item"), batch.column("item_id"), pa.array([len(t) for t, _ in bags], pa.int64()), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, ["item", "item_id", "terms", "bag"])

    kind = rows.schema["item_id"].dataType.simpleString()
    return written(rows.mapInArrow(run, f"item long, item_id {kind}, terms long, bag binary"), "items")


def item_blocks(bags: DataFrame, block_terms: int):
    """Blocks of (item numbers, their terms, their counts), read one partition at a time."""
    some, size = [], 0
    for r in bags.where("terms > 0").select("item", "terms", "bag").toLocalIterator():
        if size and size + r["terms"] > block_terms:
            yield some
            some, size = [], 0
        terms, count = B.unpack(bytes(r["bag"]))
        some.append((r["item"], np.cumsum(terms, dtype=np.uint64), count.astype(np.int64)))
        size += r["terms"]
    if some:
        yield some


# --- trees --------------------------------------------------------------------------------------


@dataclass
class Vectors:
    """Sparse rows: entries ``at[i]:at[i + 1]`` of row i are (term, value), with terms in order."""

    at: np.ndarray
    term: np.ndarray
    value: np.ndarray

    def __len__(self) -> int:
        return len(self.at) - 1

    def spots(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places of the entries of some rows, one row after another, and where each row begins."""
        n = self.at[rows + 1] - self.at[rows]
        first = np.cumsum(n) - n
        return np.repeat(self.at[rows] - first, n) + np.arange(int(n.sum())), first

    def dot(self, dense: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Product of each of the rows (none of them empty) with a dense vector."""
        if not len(rows):
            return np.zeros(0, np.int64)
        if len(rows) == len(self):
            return np.add.reduceat(dense[self.term] * self.value, self.at[:-1])
        spot, first = self.spots(rows)
        return np.add.reduceat(dense[self.term[spot]] * self.value[spot], first)

    def take(self, rows: np.ndarray) -> Vectors:
        spot, first = self.spots(rows)
        return Vectors(np.append(first, len(spot)), self.term[spot], self.value[spot])

    def maxima(self, fan: int, width: int) -> Vectors:
        """One row for each ``fan`` rows, with the maximum of each coordinate."""
        node = np.repeat(np.arange(len(self)) // fan, np.diff(self.at))
        key = node * width + self.term
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        key = key[first]
        nodes = -(-len(self) // fan)
        return Vectors(np.searchsorted(key // width, np.arange(nodes + 1), "left"), key % width, np.maximum.reduceat(self.value[order], first))


def hierarchy(rows: Vectors, leaf: int, fan: int, width: int) -> list[Vectors]:
    """Levels from the rows themselves up to a level of at most ``fan`` nodes."""
    levels = [rows]
    while len(levels) == 1 or len(levels[-1]) > fan:
        levels.append(levels[-1].maxima(leaf if len(levels) == 1 else fan, width))
    return levels


def alike(rows: Vectors, weight: np.ndarray) -> np.ndarray:
    """An order of the rows that puts those with the same heaviest coordinate side by side: the maxima of a
    node are then near the values of its rows."""
    heavy = rows.value * weight[rows.term]
    top = np.maximum.reduceat(heavy, rows.at[:-1])
    is_top = heavy == np.repeat(top, np.diff(rows.at))
    row = np.repeat(np.arange(len(rows)), np.diff(rows.at))[is_top]
    term = rows.term[is_top][np.searchsorted(row, np.arange(len(rows)), "left")]
    return np.lexsort((top, term))


class Search:
    """One block of items: its terms, weights and tree, and the walk against blocks of documents."""

    def __init__(self, block: list, k: int):
        self.k = k
        self.terms = np.unique(np.concatenate([t for _, t, _ in block]))
        self.names = np.array([n for n, _, _ in block], np.int64)
        at = np.cumsum([0, *(len(t) for _, t, _ in block)])
        number = np.searchsorted(self.terms, np.concatenate([t for _, t, _ in block]))
        self.items = Vectors(at, number, np.concatenate([c for _, _, c in block]))

    def weigh(self, documents: int, words: int, frequency: dict[int, int]) -> Search:
        """Take in the corpus: N, L and the document frequency of each term (by its number)."""
        self.documents, self.words = documents, max(1, words)
        w = [math.floor(WEIGHT * math.log((2 * documents + 2) / (2 * frequency.get(i, 0) + 1))) for i in range(len(self.terms))]
        self.weight = np.array(w, np.int64)
        rows = Vectors(self.items.at, self.items.term, self.items.value * self.weight[self.items.term])
        order = alike(rows, np.ones(len(self.terms), np.int64))
        self.names = self.names[order]
        self.tree = hierarchy(rows.take(order), ITEM_LEAF, ITEM_FAN, len(self.terms))
        return self

    def units(self, n: np.ndarray, at: np.ndarray, tf: np.ndarray) -> np.ndarray:
        """What a unit of weight scores in a document of n terms that holds a term tf times."""
        m = 75 + (25 * n * self.documents) // self.words
        return (UNIT * tf) // (SATURATION * tf + LENGTH * np.repeat(m, np.diff(at)))

    def start(self):
        """No documents yet: for each item its best (score, id, whether the id is null)."""
        return [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)) for _ in self.names], np.zeros(len(self.names), np.int64)

    def walk(self, best: list, weakest: np.ndarray, ids: np.ndarray, null: np.ndarray, docs: Vectors) -> int:
        """Hold a block of documents (none without entries) against all items; ``best`` and ``weakest``, the
        k-th score of each item, follow. Returns how many scores were worked out."""
        width = len(self.terms)
        order = alike(docs, self.weight)
        ids, null, levels = ids[order], null[order], hierarchy(docs.take(order), LEAF, FAN, width)
        dense, scored = np.zeros(width, np.int64), 0

        def children(level: int, nodes: np.ndarray) -> np.ndarray:
            """The nodes one level further down."""
            fan = LEAF if level == 1 else FAN
            below = (nodes[:, None] * fan + np.arange(fan)).ravel()
            return below[below < len(levels[level - 1])]

        def against(vector: Vectors, row: int, level: int, nodes: np.ndarray) -> np.ndarray:
            a, b = vector.at[row], vector.at[row + 1]
            dense[vector.term[a:b]] = vector.value[a:b]
            out = levels[level].dot(dense, nodes)
            dense[vector.term[a:b]] = 0
            return out

        def add(item: int, score: np.ndarray, rows: np.ndarray) -> None:
            ok = (score > 0) & (score >= weakest[item])
            s, i, z = best[item]
            s, i, z = np.append(s, score[ok]), np.append(i, ids[rows[ok]]), np.append(z, null[rows[ok]])
            top = np.lexsort((i, z, -s))[: self.k]
            best[item] = s[top], i[top], z[top]
            if len(top) == self.k:
                weakest[item] = s[top[-1]]

        def one(item: int, level: int, nodes: np.ndarray) -> None:
            """A single item against some nodes of a level, highest bounds first."""
            nonlocal scored
            bound = against(self.tree[0], item, level, nodes)
            if level == 0:
                scored += len(nodes)
                add(item, bound, nodes)
                return
            order = np.argsort(-bound, kind="stable")
            nodes, bound, lo, step = nodes[order], bound[order], 0, 1
            while lo < len(nodes) and bound[lo] > 0 and bound[lo] >= weakest[item]:
                hi = lo + int(np.searchsorted(-bound[lo : lo + step], -max(1, weakest[item]), "right"))
                one(item, level - 1, children(level, nodes[lo:hi]))
                lo, step = hi, step * 4

        def pair(item_level: int, node: int, level: int, nodes: np.ndarray) -> None:
            """A node of items against some nodes of documents."""
            if item_level == 0:
                one(node, level, nodes)
                return
            fan = ITEM_LEAF if item_level == 1 else ITEM_FAN
            span = ITEM_LEAF * ITEM_FAN ** (item_level - 1)
            least = weakest[node * span : (node + 1) * span].min()
            bound = against(self.tree[item_level], node, level, nodes)
            nodes = nodes[(bound > 0) & (bound >= least)]
            if not len(nodes):
                return
            if level > 1:
                level, nodes = level - 1, children(level, nodes)
            for child in range(node * fan, min((node + 1) * fan, len(self.tree[item_level - 1]))):
                pair(item_level - 1, child, level, nodes)

        top = len(levels) - 1
        for doc_node in range(len(levels[top])):  # one after another: the first raise what the others must reach
            for node in range(len(self.tree[-1])):
                pair(len(self.tree) - 1, node, top, np.array([doc_node]))
        return scored


# --- documents ----------------------------------------------------------------------------------


def bags(docs: DataFrame, id_col: str, text_col: str, terms: np.ndarray) -> DataFrame:
    """One row for each slice of documents: ``documents`` (with at least one term), ``words`` (their terms) and, packed,
    ids, null marks, lengths, and the counts of the given terms (sorted hashes) in each document that has one."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches):
        known, width = shared.value, len(shared.value)
        for batch in batches:
            data, offsets = W.text_bytes(batch.column("text"))
            id_column = batch.column("id")
            ids = id_column.fill_null(0).to_numpy(zero_copy_only=False)
            null = np.asarray(id_column.is_null())
            for a, b in W.slices(offsets):
                lo, hi = int(offsets[a]), int(offsets[b])
                row, _, _, h = W.words(data[lo:hi], offsets[a : b + 1] - lo, W.ALNUM, W.LOWER)
                n = np.bincount(row, minlength=b - a)
                number = np.searchsorted(known, h)
                number[number == width] = 0
                hit = known[number] == h
                key, tf = np.unique(row[hit] * width + number[hit], return_counts=True)
                has = np.flatnonzero(np.bincount(key // width, minlength=b - a))
                size = np.diff(np.searchsorted(key // width, np.append(has, b - a), "left"))
                arrays = [ids[a:b][has].view(np.uint64), null[a:b][has], n[has], size, key % width, tf]
                packed = B.pack(*(x.astype(np.uint64) for x in arrays))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int((n > 0).sum())], pa.int64()), pa.array([len(h)], pa.int64()), pa.array([packed], pa.binary())],
                    ["documents", "words", "bag"],
                )

    rows = docs.select(B.quoted(id_col).cast("long").alias("id"), B.quoted(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "documents long, words long, bag binary")


def frequencies(held: DataFrame, width: int) -> dict[int, int]:
    """Documents that hold each term: summed in each task, then over all."""

    def run(batches):
        total = np.zeros(width, np.int64)
        for batch in batches:
            for bag in batch.column("bag"):
                total += np.bincount(B.unpack(bag.as_py())[4].astype(np.int64), minlength=width)
        term = np.flatnonzero(total)
        for lo in range(0, len(term), 65_536):
            some = term[lo : lo + 65_536]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], ["term", "n"])

    rows = held.select("bag").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    return {r["term"]: r["n"] for r in rows.collect()}  # at most one row for each term of a block of items


def _ranked(search, block_entries: int):
    def run(batches):
        s = search.value
        best, weakest = s.start()
        held, size = [], 0

        def flush():
            nonlocal held, size
            if size:
                ids, null, n, count, term, tf = (np.concatenate(x) for x in zip(*held))
                at = np.append(0, np.cumsum(count.astype(np.int64)))
                tf = tf.astype(np.int64)
                docs = Vectors(at, term.astype(np.int64), s.units(n.astype(np.int64), at, tf))
                s.walk(best, weakest, ids.view(np.int64), null.astype(bool), docs)
            held, size = [], 0

        for batch in batches:
            for bag in batch.column("bag"):
                arrays = B.unpack(bag.as_py())
                if size + len(arrays[4]) > block_entries:
                    flush()
                if len(arrays[4]):
                    held.append(arrays)
                    size += len(arrays[4])
        flush()
        n = [len(b[0]) for b in best]
        if sum(n):
            score, ids, null = (np.concatenate([b[c] for b in best]) for c in range(3))
            cols = [pa.array(np.repeat(s.names, n)), pa.array(ids, mask=null), pa.array(score)]
            yield pa.RecordBatch.from_arrays(cols, ["item", "doc_id", "score"])

    return run


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    block_terms: int = TERMS,
    block_entries: int = ENTRIES,
) -> DataFrame:
    """The k best documents of each item: ``item`` (its number), ``item_id``, ``rank``, ``doc_id``, ``score``."""
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    asked = item_bags(items, item_col, item_text)
    found = None
    for block in item_blocks(asked, block_terms):
        search = Search(block, k)
        held = written(bags(docs, id_col, text_col, search.terms), "bags")
        total = held.agg(F.sum("documents").alias("n"), F.sum("words").alias("l")).first()
        search.weigh(total["n"] or 0, total["l"] or 0, frequencies(held, len(search.terms)))
        shared = spark.sparkContext.broadcast(search)
        part = held.select("bag").mapInArrow(_ranked(shared, block_entries), "item long, doc_id long, score long")
        # two steps: an item's rows of all tasks are not brought to one place at once
        salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))
        part = _best(part.withColumn("salt", salt), ["item", "salt"], k).drop("salt", "rank")
        part = _best(part, ["item"], k)
        found = part if found is None else found.union(part)
    if found is None:
        found = spark.createDataFrame([], "item long, doc_id long, score long, rank int")
    named = asked.select("item", "item_id")
    return found.join(named, "item").select("item", "item_id", "rank", "doc_id", "score")


def _best(rows: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def op11_dual_tree_search(spark, sf_dir: str) -> DataFrame:
    """Contract query: the 20 best of all ``documents`` for each row of ``benchmark``."""
    found = ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)
    return found.select("item_id", "rank", "doc_id", "score")


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP11_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS a FROM documents),
  i AS (SELECT row_number() OVER () AS q, item_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS a FROM benchmark),
  s AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(a)) AS BIGINT) AS all_terms FROM d WHERE len(a) > 0),
  tf AS (SELECT r, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT r, unnest(a) AS term FROM d) GROUP BY r, term),
  w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, s GROUP BY term, n_docs),
  asked AS (SELECT q, term, count(*) AS c FROM (SELECT q, unnest(a) AS term FROM i) GROUP BY q, term),
  scores AS (
    SELECT q, d.r, CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * len(d.a) * n_docs) // all_terms)))) AS BIGINT) AS score
    FROM asked JOIN w USING (term) JOIN tf USING (term) JOIN d USING (r), s GROUP BY q, d.r),
  ranked AS (SELECT i.item_id, d.doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, d.doc_id) AS rank
    FROM scores JOIN i USING (q) JOIN d USING (r) WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""
