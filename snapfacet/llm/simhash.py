"""Operator 10, SimHash near-duplicates by a binary trie self-join.

Fingerprints: per text the majority vote of the bits of the hashes of its word shingles.
Exact copies share a fingerprint and are one entry of the join. The distinct fingerprints form a
binary trie; pairs of its nodes are traversed together from the root, each step adds the bit in
which the two nodes differ, and a pair is given up when it has more differing bits than the
error budget. The budget grows along the path: the trie is built for four rotations of the
fingerprint, and a pair of at most k differing bits has a rotation in which its first i quarters
hold at most i*k/4 of them, for every i (the ring form of the pigeonhole principle). So no pair
is lost, and most are given up within the first quarter.

The traversal is dealt out by the trie's top nodes: a task gets the fingerprints under one pair
of nodes. Nodes too full for one task are split by further bits, so no task holds more than about
``node_size`` fingerprints a side, also where a third of all texts are near copies. A pair of
nodes whose fingerprints are known to be one component is not looked at again, and a task
answers with a spanning forest of its links, not with all pairs. The links of all tasks are
joined to components by repeated star contraction, checkpointed in the shared folder.

Defined results: a null or empty text has fingerprint zero, linked like any other; a null id
never becomes a component's id (null if the component has no other); repeated rows keep their
number; an empty table gives an empty result. Other columns, whatever their names, are in ``row``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir, ship_package, table
from . import blocks as B
from . import words as W

SEED = 42
NODE = 32_768
ROTATIONS = (0, 16, 32, 48)
_U = np.uint64


def _fingerprint(words: list[bytes], k: int) -> int:
    """Majority vote over the shingles of k words (fewer words: the whole sequence)."""
    if not words:
        return 0
    text = b" ".join(words)
    if len(words) <= k:
        return xxhash.xxh64_intdigest(text, SEED)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[: len(words) - k] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    total, n = np.zeros(64, np.int64), 0
    ends = ends[k - 1 :].tolist()
    for i in range(0, len(ends), 65536):  # bounded memory for very long texts
        h = np.array([digest(text[s:e], SEED) for s, e in zip(starts[i : i + 65536], ends[i : i + 65536])], dtype="<u8")
        total += np.unpackbits(h.view(np.uint8).reshape(len(h), 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(h)
    return int(np.packbits(2 * total > n, bitorder="little").view("<u8")[0])


def simhash(docs: DataFrame, text_col: str = "text", shingle_words: int = 4) -> DataFrame:
    """``row`` (all columns but the text) and ``fingerprint`` (its 64 bits as a signed long)."""
    ship_package(docs.sparkSession)
    fold = bytes(W.LOWER)

    def run(batches):
        for batch in batches:
            out = []
            for text in batch.column("_text"):
                raw = text.as_buffer() if text.is_valid else b""
                # bytes.split() parts at the same six characters as the word rule
                out.append(_fingerprint(bytes(raw).translate(fold).split(), shingle_words))
            fp = pa.array(np.array(out, dtype=np.uint64).view(np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("row"), fp], ["row", "fingerprint"])

    row = F.struct(*(B.quoted(c) for c in docs.columns if c != text_col))
    d = docs.select(row.alias("row"), B.quoted(text_col).cast("string").alias("_text"))
    schema = T.StructType().add("row", d.schema["row"].dataType).add("fingerprint", "long")
    return d.mapInArrow(run, schema)


# --- the traversal of one pair of nodes, in a task ------------------------------------------


def _rotate(fp: np.ndarray, by: int) -> np.ndarray:
    return (fp << _U(by)) | (fp >> _U(64 - by)) if by else fp


def _budgets(max_bits: int) -> np.ndarray:
    """Differing bits allowed in the first d bits of a rotation, for d = 0..64."""
    quarter = np.minimum((np.arange(65) + 15) // 16, 4)
    return quarter * max_bits // 4


def _components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of n nodes over the links (a, b)."""
    label = np.arange(n)
    while len(a):
        la, lb = label[a], label[b]
        different = la != lb
        a, b, la, lb = a[different], b[different], la[different], lb[different]
        low, high = np.minimum(la, lb), np.maximum(la, lb)
        np.minimum.at(label, high, low)
        while True:  # follow the links to the root
            up = label[label]
            if (up == label).all():
                break
            label = up
    return label


def _neighbours(fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between neighbours in the order of each rotation: they make the components of
    dense groups known before the traversal."""
    a, b = [], []
    for by in ROTATIONS:
        order = np.argsort(_rotate(fp, by), kind="stable")
        near = np.bitwise_count(fp[order[1:]] ^ fp[order[:-1]]) <= max_bits
        a.append(order[:-1][near])
        b.append(order[1:][near])
    return np.concatenate(a), np.concatenate(b)


class _Trie:
    """Nodes of the trie of sorted, distinct values, one level at a time from ``depth``."""

    def __init__(self, values: np.ndarray, labels: np.ndarray, depth: int):
        self.values, self.labels, self.depth = values, labels, depth
        self.first = self._cuts(depth)

    def _cuts(self, depth: int) -> np.ndarray:
        if depth == 0:
            return np.array([0, len(self.values)])
        top = self.values >> _U(64 - depth)
        return np.append(np.flatnonzero(np.append(True, top[1:] != top[:-1])), len(top))

    def down(self):
        """To the next level: for each node its child under bit 0 and under bit 1 (-1: none)."""
        old, self.depth = self.first, self.depth + 1
        self.first = self._cuts(self.depth)
        parent = np.searchsorted(old, self.first[:-1], "right") - 1
        bit = ((self.values[self.first[:-1]] >> _U(64 - self.depth)) & _U(1)).astype(np.int64)
        child = np.full((2, len(old) - 1), -1)
        child[bit, parent] = np.arange(len(parent))
        return child

    def sizes(self) -> np.ndarray:
        return np.diff(self.first)

    def uniform(self) -> np.ndarray:
        """The label that all values of a node have, or -1."""
        low = np.minimum.reduceat(self.labels, self.first[:-1])
        return np.where(low == np.maximum.reduceat(self.labels, self.first[:-1]), low, -1)


LEAF, SLAB = 16, 2_000_000


def _pairs(trie_a: _Trie, trie_b: _Trie, a, b, same: bool, max_bits: int):
    """Links between the values under the node pairs (a, b), compared in slabs."""
    na, nb = trie_a.sizes()[a], trie_b.sizes()[b]
    count = na * nb
    edge = np.searchsorted(np.cumsum(count), np.arange(SLAB, int(count.sum()) + SLAB, SLAB), "left")
    lo, out = 0, []
    for hi in np.unique(np.minimum(edge + 1, len(a))):
        c = count[lo:hi]
        pair = np.repeat(np.arange(lo, hi), c)
        k = np.arange(int(c.sum())) - np.repeat(np.cumsum(c) - c, c)
        i = trie_a.first[a[pair]] + k // nb[pair]
        j = trie_b.first[b[pair]] + k % nb[pair]
        near = np.bitwise_count(trie_a.values[i] ^ trie_b.values[j]) <= max_bits
        if same:
            near &= i < j
        out.append((i[near], j[near]))
        lo = hi
    return out


def _traverse(values_a, labels_a, values_b, labels_b, same: bool, depth: int, spent: int, max_bits: int):
    """All links between two sorted sets whose first ``depth`` bits differ in ``spent`` places,
    but for those between values of one component."""
    budget = _budgets(max_bits)
    ta = _Trie(values_a, labels_a, depth)
    tb = ta if same else _Trie(values_b, labels_b, depth)
    a, b, diff, out = np.array([0]), np.array([0]), np.array([spent]), []
    while len(a):
        ua, ub = ta.uniform(), tb.uniform()
        fresh = (ua[a] != ub[b]) | (ua[a] < 0)
        a, b, diff = a[fresh], b[fresh], diff[fresh]
        small = (ta.sizes()[a] * tb.sizes()[b] <= LEAF) | (ta.depth == 64)
        if small.any():
            out += _pairs(ta, tb, a[small], b[small], same, max_bits)
            a, b, diff = a[~small], b[~small], diff[~small]
        if not len(a):
            break
        ca = ta.down()
        cb = ca if same else tb.down()
        left, right, bits = [], [], []
        for x in (0, 1):
            for y in (0, 1):
                na, nb, d = ca[x][a], cb[y][b], diff + (x != y)
                ok = (na >= 0) & (nb >= 0) & (d <= budget[ta.depth])
                if same and (x, y) == (1, 0):
                    ok &= a != b  # of a node with itself, each pair of children once
                left.append(na[ok])
                right.append(nb[ok])
                bits.append(d[ok])
        a, b, diff = np.concatenate(left), np.concatenate(right), np.concatenate(bits)
    if not out:
        z = np.zeros(0, np.int64)
        return z, z
    return np.concatenate([o[0] for o in out]), np.concatenate([o[1] for o in out])


def _forest(fp_a: np.ndarray, fp_b: np.ndarray | None, by: int, depth: int, spent: int, max_bits: int):
    """Spanning stars (node, root) of the links found under one pair of nodes."""
    same = fp_b is None
    fp = fp_a if same else np.concatenate((fp_a, fp_b))
    a, b = _neighbours(fp, max_bits)
    label = _components(len(fp), a, b)
    ra = _rotate(fp_a, by)
    oa = np.argsort(ra)
    ob = oa if same else np.argsort(rb := _rotate(fp_b, by)) + len(fp_a)
    vb = ra[oa] if same else rb[ob - len(fp_a)]
    i, j = _traverse(ra[oa], label[oa], vb, label[ob], same, depth, spent, max_bits)
    known = np.flatnonzero(label != np.arange(len(fp)))
    label = _components(len(fp), np.concatenate((known, oa[i])), np.concatenate((label[known], ob[j])))
    node = np.flatnonzero(label != np.arange(len(fp)))
    return fp[node], fp[label[node]]


# --- dealing out the node pairs, and the components -----------------------------------------


def _near_prefixes(p: int, depth: int, max_bits: int) -> list[int]:
    """Prefixes of ``depth`` bits (p itself included) that the budget allows beside p."""
    budget = _budgets(max_bits)
    found = [(0, 0, 0)]  # (prefix, depth so far, differing bits)
    for d in range(1, depth + 1):
        bit = (p >> (depth - d)) & 1
        step = []
        for q, _, n in found:
            step.append((q << 1 | bit, d, n))
            if n < budget[d]:
                step.append((q << 1 | (1 - bit), d, n + 1))
        found = step
    return [q for q, _, _ in found]


def trie_links(prints: DataFrame, max_bits: int = 4, node_size: int = NODE) -> DataFrame:
    """Links (a, b) between the distinct fingerprints of column ``fingerprint``: a spanning
    forest of each task's links, which has the same components as all links."""
    prints = prints.select("fingerprint")
    n = prints.count()
    depth = min(24, max(0, math.ceil(math.log2(max(1, n) / node_size))))
    # Fuller nodes than one task should hold, by rotation: at most 4 * n / node_size of them.
    full: dict[tuple[int, int], int] = {}
    for r, by in enumerate(ROTATIONS):
        counts = prints.groupBy(_top(F.col("fingerprint"), by, depth).alias("p")).count().where(F.col("count") > 4 * node_size)
        full |= {(r, x["p"]): math.ceil(x["count"] / (2 * node_size)) for x in counts.collect()}

    def deal(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            rows = []
            for r, by in enumerate(ROTATIONS):
                turned = _rotate(fp, by)
                top = (turned >> _U(64 - depth)).astype(np.int64) if depth else np.zeros(len(fp), np.int64)
                order = np.argsort(top, kind="stable")
                cut = np.append(np.flatnonzero(np.append(True, top[order][1:] != top[order][:-1])), len(fp))
                for s, e in zip(cut[:-1], cut[1:]):
                    if s == e:
                        continue
                    p = int(top[order[s]])
                    mine = np.sort(fp[order[s:e]])
                    parts = full.get((r, p), 1)
                    salt = (W.mix(mine) % _U(parts)).astype(np.int64)
                    for q in _near_prefixes(p, depth, max_bits):
                        others = full.get((r, q), 1)
                        spent = int(p ^ q).bit_count()
                        for i in range(parts):
                            block = B.pack(B.delta(mine[salt == i])) if parts > 1 else B.pack(B.delta(mine))
                            for j in range(others):
                                # the two sides of a pair of (node, part), in one order for both
                                one, two = sorted(((p, i), (q, j)))
                                rows.append((r, *one, *two, spent, int((p, i) != one), block))
            names = ("r", "p", "i", "q", "j", "spent", "side", "block")
            cols = list(zip(*rows)) if rows else [()] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols[:7]] + [pa.array(cols[7], pa.binary())], names)

    def meet(group: pa.Table) -> pa.Table:
        first = {k: group[k][0].as_py() for k in ("r", "p", "i", "q", "j", "spent")}
        sides = ([], [])
        for side, block in zip(group["side"].to_pylist(), group["block"].to_pylist()):
            sides[side].append(np.cumsum(B.unpack(block)[0], dtype=np.uint64))
        a, b = (np.unique(np.concatenate(s)) if s else np.zeros(0, np.uint64) for s in sides)
        same = (first["p"], first["i"]) == (first["q"], first["j"])
        if len(a) == 0 or (len(b) == 0 and not same):
            u = v = np.zeros(0, np.uint64)
        else:
            u, v = _forest(a, None if same else b, ROTATIONS[first["r"]], depth, first["spent"], max_bits)
        return pa.table({"a": pa.array(u.view(np.int64), pa.int64()), "b": pa.array(v.view(np.int64), pa.int64())})

    dealt = prints.mapInArrow(deal, "r long, p long, i long, q long, j long, spent long, side long, block binary")
    return dealt.groupBy("r", "p", "i", "q", "j").applyInArrow(meet, "a long, b long")


def _top(fp, by: int, depth: int):
    """The first ``depth`` bits of a rotated fingerprint, as a column."""
    if not depth:
        return F.lit(0).cast("long")
    turned = F.shiftleft(fp, by).bitwiseOR(F.shiftrightunsigned(fp, 64 - by)) if by else fp
    return F.shiftrightunsigned(turned, 64 - depth)


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every linked node: star contraction, each round a minimum per node and
    a join; a round at most doubles what is written and the number of rounds grows with the
    logarithm of the longest chain."""
    ensure_checkpoint_dir(links.sparkSession)
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct().checkpoint()
    state = lambda e: tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
    now = state(edges)
    while True:
        # large star: a node's larger neighbours, linked to its smallest one
        both = edges.union(edges.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        edges = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: a node and its smaller neighbours, linked to the smallest one
        low = edges.groupBy("u").agg(F.min("v").alias("m"))
        moved = edges.join(low, "u")
        edges = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        edges = edges.where("u <> v").distinct().checkpoint()
        before, now = now, state(edges)
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 4, max_bits: int = 4, node_size: int = NODE
) -> DataFrame:
    """Per row of ``docs``: ``row``, ``fingerprint`` (16 hex digits), ``component_id``, the smallest
    id reachable over links of at most ``max_bits`` differing bits, and ``component``, a fingerprint
    that names the component also where it has no id."""
    ensure_checkpoint_dir(docs.sparkSession)
    prints = simhash(docs, text_col, shingle_words).withColumn("_id", B.quoted("row")[id_col].cast("long")).checkpoint()
    classes = prints.groupBy("fingerprint").agg(F.min("_id").alias("least"))
    roots = components(trie_links(classes, max_bits, node_size))
    classes = classes.join(roots, classes["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")
    )
    smallest = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    named = classes.join(smallest, "root").select(F.col("fingerprint").alias("_fp"), "component_id", F.col("root").alias("component"))
    out = prints.join(named, prints["fingerprint"] == named["_fp"], "left")
    return out.select("row", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id", "component")


def op10_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Contract query: shingles of 4 words, at most 4 differing bits, whole ``documents``."""
    out = near_duplicates(table(spark, sf_dir, "documents"), shingle_words=4, max_bits=4)
    return out.select("row.doc_id", "fingerprint", "component_id")
