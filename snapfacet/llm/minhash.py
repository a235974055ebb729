"""Operator 13, MinHash near-duplicates with circulant signatures.

Two permutations of the 64-bit numbers make all coordinates of a signature. The first moves each
shingle to its place, sigma(x); the second, pi, is read once for each coordinate k after a circular
shift by k: coordinate k is the least pi(sigma(x) - k) over a text's distinct shingles x. No further
permutation is drawn, however long the signature is.

Texts with one shingle set are one class; the classes are what is compared. Bands of ``rows``
coordinates are the keys of buckets. With 32 bands of 5, two sets at the limit of 0.85 share no
bucket with a chance of about 7e-9. The share of equal coordinates of two signatures estimates their similarity;
pairs with so few that a linked pair has them with a chance of about 1e-9 (``least_matches``) are given
up, all others are verified on the full shingle sets.

Only components are wanted, so no list of pairs is ever made. A class's home is the largest bucket within
a few steps of it; homes are cut into blocks of at most ``block`` classes and ``BLOCK_SHINGLES`` shingles, or one class.
A block's task has its sets and takes the pairs of different components best estimate first: it verifies, joins what
passes, and goes on until no pair is left, so nothing is capped; it answers with a spanning forest of its links.
In a home of several blocks some classes, the pivots, are in every block, so that the blocks of a group of near
copies fall together at once. What is left are pairs that share a bucket, but no block and no component: a
second pass brings the two blocks of such pairs together, of each bucket only what is outside its main component and what that
has to be held against. A group of copies is thus read a fixed number of times, whatever its size; only classes that
stay outside cost more.

Defined results: a text without words, or null, has no shingles, is linked with nothing and is its
own component; fewer words than a shingle are one shingle; rows with one shingle set are linked; a
null id never becomes a component's id (null if the component has no other); repeated rows keep
their number; an empty table gives an empty result. Other columns, whatever their names, are in ``row``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir, scratch, ship_package, table
from . import blocks as B
from . import words as W
from .simhash import _components, components

BANDS, ROWS, BLOCK = 32, 5, 2048
BLOCK_SHINGLES, PIVOTS, STEPS = 2_000_000, 64, 3
SLAB = 1 << 15
_U = np.uint64
#: Fixed odd numbers: the keys of the two permutations and of a set's two sums.
SIGMA, PI = _U(0x9E6C63D0676A9A99), _U(0xC2B2AE3D27D4EB4F)


def _permute(x: np.ndarray, key: np.uint64) -> np.ndarray:
    """A permutation of the 64-bit numbers."""
    x = (x ^ (x >> _U(31))) * key
    x = (x ^ (x >> _U(28))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(32))


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table of the shared folder: lineage ends here, columns can be read apart."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shingles(column, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each row of an Arrow string column: (hashes, row offsets)."""
    data, offsets = W.text_bytes(column)
    rows, _, _, h = W.words(data, offsets, W.NOT_SPACE, W.LOWER)
    n = len(offsets) - 1
    count = np.bincount(rows, minlength=n) if n else np.zeros(0, np.int64)
    inside = W.within(rows, words)
    at, x = rows[: len(inside)][inside], W.windows(h, words)[inside]
    short = np.flatnonzero((count > 0) & (count < words))
    if len(short):  # the whole sequence, apart from longer ones by its number of words
        first = np.searchsorted(rows, short, "left")
        whole = np.zeros(len(short), np.uint64)
        for i in range(words - 1):
            there = count[short] > i
            whole[there] = W.mix(whole[there] ^ h[first[there] + i]) + _U(i)
        at, x = np.concatenate((at, short)), np.concatenate((x, W.mix(whole ^ count[short].astype(np.uint64))))
    order = np.lexsort((x, at))
    at, x = at[order], x[order]
    new = np.ones(len(x), bool)
    new[1:] = (x[1:] != x[:-1]) | (at[1:] != at[:-1])
    return x[new], np.concatenate(([0], np.cumsum(np.bincount(at[new], minlength=n)))) if n else np.zeros(1, np.int64)


def signatures(x: np.ndarray, offsets: np.ndarray, size: int) -> np.ndarray:
    """``size`` circulant coordinates for each row of shingles (all ones for a row without any)."""
    out = np.full((len(offsets) - 1, size), 2**64 - 1, np.uint64)
    place = _permute(x, SIGMA)
    for lo in range(0, len(x), SLAB):  # a row may go over several slabs
        hi = min(lo + SLAB, len(x))
        rows = np.flatnonzero((offsets[1:] > lo) & (offsets[:-1] < hi) & (offsets[1:] > offsets[:-1]))
        cut = np.maximum(offsets[rows], lo) - lo
        for k in range(size):  # pi, shifted by k
            low = np.minimum.reduceat(_permute(place[lo:hi] - _U(k), PI), cut)
            out[rows, k] = np.minimum(out[rows, k], low)
    return out


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """The bucket of each band: one 64-bit number, different for different bands."""
    keys = np.empty((len(signature), bands), np.uint64)
    for b in range(bands):
        key = np.full(len(signature), W.mix(np.array([b + 1], np.uint64))[0])
        for k in range(b * rows, (b + 1) * rows):
            key = W.mix(key ^ signature[:, k]) + _U(k)
        keys[:, b] = key
    return keys


def least_matches(size: int, similarity: float, chance: float = 1e-9) -> int:
    """The number of equal coordinates that a pair at the limit stays under with that chance only."""
    total, at = 0.0, 0
    for at in range(size + 1):
        total += math.comb(size, at) * similarity**at * (1 - similarity) ** (size - at)
        if total > chance:
            break
    return at


def sketch(docs: DataFrame, text_col: str, words: int, bands: int, band_rows: int) -> DataFrame:
    """Per row: ``row``, ``n_shingles``, the set's two 64-bit sums ``h1`` and ``h2``, its
    bands' ``keys``, the low bytes of its signature as ``sign``, and its ``text`` (packed)."""
    ship_package(docs.sparkSession)
    schema_row = F.struct(*(B.quoted(c) for c in docs.columns if c != text_col))
    d = docs.select(schema_row.alias("row"), B.quoted(text_col).cast("string").alias("text"))
    schema = T.StructType().add("row", d.schema["row"].dataType).add("n_shingles", "long").add("h1", "long").add("h2", "long")
    schema = schema.add("keys", "binary").add("sign", "binary").add("text", "binary")

    def run(batches):
        codec = pa.Codec("zstd", 1)
        for batch in batches:
            _, offsets = W.text_bytes(batch.column("text"))
            for a, b in W.slices(offsets):
                part = batch.slice(a, b - a)
                x, at = shingles(part.column("text"), words)
                n = np.diff(at)
                some = np.flatnonzero(n)
                sums = np.zeros((2, b - a), np.uint64)
                if len(some):
                    for i in (0, 1):
                        sums[i, some] = np.add.reduceat(W.mix(x ^ _U(i * 0x5851F42D4C957F2D)), at[some])
                    sums[:, some] = W.mix(sums[:, some] ^ n[some].astype(np.uint64))
                sign = signatures(x, at, bands * band_rows)
                keys = band_keys(sign, bands, band_rows)
                low = (sign & _U(255)).astype(np.uint8)
                packed = []
                for text in part.column("text"):
                    raw = text.as_buffer() if text.is_valid else None
                    packed.append(len(raw).to_bytes(8, "little") + codec.compress(raw, asbytes=True) if raw else None)
                cols = [
                    part.column("row"),
                    pa.array(n, pa.int64()),
                    pa.array(sums[0].view(np.int64)),
                    pa.array(sums[1].view(np.int64)),
                    pa.array([k.tobytes() for k in keys], pa.binary()),
                    pa.array([s.tobytes() for s in low], pa.binary()),
                    pa.array(packed, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(cols, schema.names)

    return d.mapInArrow(run, schema)


# --- one block, or two, in a task -------------------------------------------------------------


def _matches(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Equal coordinates of each signature of ``a`` with each of ``b`` (at most 255 coordinates)."""
    out = np.zeros((len(a), len(b)), np.uint8)
    for k in range(a.shape[1]):
        out += a[:, k, None] == b[None, :, k]
    return out


class Sets:
    """Shingle sets with the shingles numbered."""

    def __init__(self, sets: list[np.ndarray]):
        self.at = np.cumsum([0, *map(len, sets)])
        _, self.term = np.unique(np.concatenate(sets), return_inverse=True)
        self.size = np.diff(self.at)
        self.mark = np.zeros(int(self.term.max(initial=0)) + 1, bool)

    def common(self, a: int, others: np.ndarray) -> np.ndarray:
        """Shingles that set ``a`` shares with each of the others (none of them empty)."""
        mine = self.term[self.at[a] : self.at[a + 1]]
        self.mark[mine] = True
        n = self.size[others]
        first = np.cumsum(n) - n
        spot = np.repeat(self.at[others] - first, n) + np.arange(int(n.sum()))
        out = np.add.reduceat(self.mark[self.term[spot]], first, dtype=np.int64)
        self.mark[mine] = False
        return out


def spanning_links(sign: np.ndarray, label: np.ndarray, sets: Sets, a: np.ndarray, b: np.ndarray, least: int, top: int):
    """Verified links between the classes ``a`` and the classes ``b`` (numbers of rows; ``a`` is ``b`` for one
    block): with the labels they make the components that all links of 10000 * common >= top * union make. Pairs
    of one component are passed over, others come up with the best estimates first, twice as many each time."""
    same = a is b
    m = _matches(sign[a], sign[b])
    small, large = np.minimum.outer(sets.size[a], sets.size[b]), np.maximum.outer(sets.size[a], sets.size[b])
    m[(m < least) | (small * 10_000 < top * large)] = 0
    if same:
        m[np.tril_indices(len(a))] = 0
    found, k = [], 1
    label = np.unique(label, return_inverse=True)[1]
    while True:
        m[label[a][:, None] == label[b][None, :]] = 0
        rows = np.flatnonzero(m.any(axis=1))
        if not len(rows):
            break
        some = m[rows]
        best = np.argpartition(some, len(b) - k, axis=1)[:, len(b) - k :] if k < len(b) else np.broadcast_to(np.arange(len(b)), some.shape)
        for r, columns in zip(rows, best):
            columns = columns[m[r, columns] > 0]
            common = sets.common(a[r], b[columns])
            ok = common * 10_000 >= top * (sets.size[a[r]] + sets.size[b[columns]] - common)
            found += [(int(a[r]), int(x)) for x in b[columns[ok]]]
            m[r, columns] = 0
        if found:
            i, j = np.array(found).T
            label = _components(int(label.max()) + 1, label[i], label[j])[label]
        k *= 2
    return found


def _forest(found: list, label: np.ndarray) -> list:
    """Those of the links that join something."""
    up, out = {}, []

    def root(x):
        while up.get(x, x) != x:
            x = up[x]
        return x

    for i, j in found:
        x, y = root(int(label[i])), root(int(label[j]))
        if x != y:
            up[max(x, y)] = min(x, y)
            out.append((i, j))
    return out


def _linked(size: int, words: int, least: int, top: int):
    """Rows sorted by task (side 0: one block with itself; 1 and 2: the two blocks) -> links."""

    def work(rows: pa.Table) -> pa.RecordBatch:
        node, side, label = (rows[c].to_numpy() for c in ("node", "side", "label"))
        out = []
        if (label != label[0]).any():
            sign = np.frombuffer(b"".join(rows["sign"].to_pylist()), np.uint8).reshape(len(node), size)
            sets = Sets([np.cumsum(B.unpack(x.as_py())[0], dtype=np.uint64) for x in rows["set"]])
            a = np.flatnonzero(side < 2)
            b = np.flatnonzero(side == 2) if side.any() else a
            out = _forest(spanning_links(sign, label, sets, a, b, least, top), label) if len(a) and len(b) else []
        pairs = np.array(out, np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(node[pairs[:, 0]], pa.int64()), pa.array(node[pairs[:, 1]], pa.int64())], ["a", "b"])

    def run(batches):
        held = []
        for batch in batches:
            task = batch.column("task").to_numpy(zero_copy_only=False)
            if not len(task):
                continue
            cuts = np.append(np.flatnonzero(np.append(True, task[1:] != task[:-1])), len(task))
            if held and held[0].column("task")[0].as_py() != task[0]:
                yield work(pa.Table.from_batches(held))
                held = []
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                held.append(batch.slice(int(lo), int(hi - lo)))
                if hi < len(task):  # the last one may go on in the next batch
                    yield work(pa.Table.from_batches(held))
                    held = []
        if held:
            yield work(pa.Table.from_batches(held))

    return run


# --- the join ---------------------------------------------------------------------------------


def _sets(words: int):
    """(node, text) -> (node, shingle set, packed)."""

    def made(nodes, texts):
        x, at = shingles(pa.array(texts, pa.string()), words)
        packed = [B.pack(B.delta(x[a:b])) for a, b in zip(at[:-1], at[1:])]
        return [pa.array(nodes, pa.int64()), pa.array(packed, pa.binary())]

    def run(batches):
        for batch in batches:
            nodes, texts, size = [], [], 0
            for node, text in zip(batch.column("node").to_pylist(), batch.column("text")):
                raw = text.as_buffer()
                texts.append(pa.decompress(raw[8:], int.from_bytes(raw[:8], "little"), codec="zstd", asbytes=True).decode())
                nodes.append(node)
                size += len(texts[-1])
                if size > W.SLICE:  # memory follows the slice, or the longest text
                    yield pa.RecordBatch.from_arrays(made(nodes, texts), ["node", "set"])
                    nodes, texts, size = [], [], 0
            if nodes:
                yield pa.RecordBatch.from_arrays(made(nodes, texts), ["node", "set"])

    return run


def homes(met: DataFrame) -> DataFrame:
    """(node, home): the largest bucket within ``STEPS`` steps of each class, the first of equal ones, as a
    struct (members, bucket). ``met``: bucket, members, node."""
    home = met.groupBy("node").agg(F.max(F.struct("members", "bucket")).alias("home"))
    for _ in range(STEPS - 1):
        near = met.select("bucket", "node").join(home, "node")
        near = near.groupBy("bucket").agg(F.max("home").alias("home"))
        home = met.select("bucket", "node").join(near, "bucket").groupBy("node").agg(F.max("home").alias("home"))
    return home


def blocks_of(classes: DataFrame, met: DataFrame, block: int) -> DataFrame:
    """(node, home, part, parts, pivot): the block of each class is its home and part."""
    home = homes(met).select("node", F.col("home.bucket").alias("home"))
    home = home.join(classes.select("node", "n_shingles"), "node")
    sizes = home.groupBy("home").agg(F.count("*").alias("members"), F.sum("n_shingles").alias("all"))
    most = F.greatest(F.ceil(F.col("members") / F.lit(block)), F.ceil(F.col("all") / F.lit(BLOCK_SHINGLES)))
    sizes = sizes.select("home", "members", most.cast("long").alias("parts"))
    part = F.pmod(F.xxhash64("node", F.lit(1)), F.col("parts"))
    # about PIVOTS classes of a home of several blocks
    pivot = F.pmod(F.xxhash64("node", F.lit(2)), F.greatest(F.lit(1), (F.col("members") / F.lit(PIVOTS)).cast("long"))) == 0
    return home.join(sizes, "home").select("node", "home", part.alias("part"), "parts", ((F.col("parts") > 1) & pivot).alias("pivot"))


class _Join:
    """The links so far, and the component of each class that has any."""

    def __init__(self, held: DataFrame, size: int, words: int, similarity: float):
        self.held, self.links, self.roots = held, None, None
        self.run = _linked(size, words, least_matches(size, similarity), round(similarity * 10_000))

    def labelled(self, rows: DataFrame) -> DataFrame:
        if self.roots is None:
            return rows.withColumn("label", F.col("node"))
        named = self.roots.select("node", F.col("root").alias("_root"))
        return rows.join(named, "node", "left").withColumn("label", F.coalesce("_root", "node")).drop("_root")

    def take(self, rows: DataFrame) -> None:
        """Verify what the tasks of ``rows`` (task, side, node, label) hold, and join the links."""
        full = rows.join(self.held, "node").select("task", "side", "node", "label", "sign", "set")
        links = full.repartition("task").sortWithinPartitions("task", "side", "node").mapInArrow(self.run, "a long, b long")
        links = written(links, "links")
        self.links = links if self.links is None else self.links.union(links)
        self.roots = components(self.links)


def _left(met: DataFrame) -> DataFrame:
    """Tasks (task, side, node, label) of the second pass. ``met``: bucket, node, label, home, part."""
    sizes = met.groupBy("bucket", "label").agg(F.count("*").alias("n"))
    main = sizes.groupBy("bucket").agg(F.max(F.struct("n", "label"))["label"].alias("main"), F.count("*").alias("labels")).where("labels > 1")
    mixed = met.join(main.select("bucket", "main"), "bucket").withColumn("apart", F.col("label") != F.col("main"))
    places = mixed.groupBy("bucket", "home", "part").agg(F.max("apart").alias("any_apart"))
    places = places.select("bucket", F.col("home").alias("home2"), F.col("part").alias("part2"), "any_apart")
    beside = mixed.join(places, "bucket").where("(home <> home2 or part <> part2) and (apart or any_apart)")
    one, two = F.struct("home", "part"), F.struct(F.col("home2").alias("home"), F.col("part2").alias("part"))
    task = F.xxhash64(F.least(one, two), F.greatest(one, two))
    return beside.select(task.alias("task"), F.when(one < two, 1).otherwise(2).alias("side"), "node", "label").distinct()


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = 5,
    similarity: float = 0.8,
    bands: int = BANDS,
    band_rows: int = ROWS,
    block: int = BLOCK,
) -> DataFrame:
    """Per row of ``docs``: ``row``, ``n_shingles``, ``component_id``, the smallest id reachable over
    links of at least ``similarity`` (of up to four decimals), ``component``, a text that names the component also
    where it has no id (null: no shingles), and ``kept``, whether the row's id is the component's."""
    ensure_checkpoint_dir(docs.sparkSession)
    size = bands * band_rows
    # Each row's numbers, and its text for the verification, are written once.
    id_ = B.quoted("row")[id_col].cast("long").alias("_id")
    prints = written(sketch(docs, text_col, shingle_words, bands, band_rows).select("*", id_), "sketches")
    some, key = prints.where("n_shingles > 0"), ["h1", "h2", "n_shingles"]

    def buckets(batches):
        for batch in batches:
            keys = np.frombuffer(b"".join(batch.column("keys").to_pylist()), np.int64)
            h1 = np.repeat(batch.column("h1").to_numpy(zero_copy_only=False), bands)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(h1, pa.int64())], ["bucket", "h1"])

    # Buckets with two different sets; a set is known by its first sum here, by all three numbers below.
    keyed = some.select("keys", "h1").mapInArrow(buckets, "bucket long, h1 long")
    shared = keyed.groupBy("bucket").agg(F.min("h1").alias("low"), F.max("h1").alias("high")).where("low <> high")
    met = written(keyed.join(shared.select("bucket"), "bucket").distinct(), "met")
    mine = some.join(met.select("h1").distinct(), "h1", "left_semi")
    # The classes that meet another get a number that is fixed by the write.
    classes = mine.groupBy(*key).agg(F.first("sign").alias("sign"), F.first("text").alias("text"))
    classes = written(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    held = classes.select("node", "text").mapInArrow(_sets(shingle_words), "node long, set binary")
    held = written(held.join(classes.select("node", "sign"), "node"), "sets")

    members = met.groupBy("bucket").agg(F.count("*").alias("members"))
    met = written(met.join(members, "bucket").join(classes.select("h1", "node"), "h1").select("bucket", "members", "node"), "buckets")
    places = written(blocks_of(classes, met, block), "blocks")
    every = F.explode(F.when(F.col("pivot"), F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).otherwise(F.array("part")))
    first = places.select("home", every.alias("part"), "node")
    first = first.select(F.xxhash64("home", "part").alias("task"), F.lit(0).alias("side"), "node")

    join = _Join(held, size, shingle_words, similarity)
    join.take(join.labelled(first))
    join.take(_left(join.labelled(met.join(places.select("node", "home", "part"), "node"))))

    least = some.groupBy(*key).agg(F.min("_id").alias("least"))
    named = least.join(classes.select(*key, "node"), key, "left").join(join.roots, "node", "left")
    alone = F.concat_ws("-", *(F.hex(c) for c in key))
    component = F.coalesce(F.coalesce("root", "node").cast("string"), alone)
    named = named.select(*(F.col(c).alias(f"_{c}") for c in key), "least", component.alias("component"))
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(smallest, "component")
    out = prints.select("row", "_id", *key).join(named, [prints[c] == named[f"_{c}"] for c in key], "left")
    component_id = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("_id"))
    out = out.select("row", "_id", "n_shingles", component_id.alias("component_id"), "component")
    return out.select("row", "n_shingles", "component_id", "component", F.col("_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op13_minhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Contract query: sets of 3-word shingles, 0.85 or more, whole ``documents``."""
    out = near_duplicates(table(spark, sf_dir, "documents"), shingle_words=3, similarity=0.85)
    return out.select("row.doc_id", "n_shingles", "component_id", "kept")


OP13_SQL = """
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS a FROM documents),
  s AS (SELECT doc_id, CASE WHEN len(a) = 0 OR a IS NULL THEN [] WHEN len(a) < 3 THEN [array_to_string(a, ' ')]
          ELSE list_distinct(list_transform(range(1, len(a) - 1), lambda i: array_to_string(a[i:i + 2], ' '))) END AS x FROM w),
  n AS (SELECT doc_id, len(x) AS n FROM s),
  e AS MATERIALIZED (SELECT doc_id, unnest(x) AS g FROM s),
  both_ AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
  links AS MATERIALIZED (SELECT a, b FROM both_ JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
  reach AS (SELECT doc_id AS d, doc_id AS o FROM documents UNION SELECT reach.d, links.b FROM reach JOIN links ON links.a = reach.o),
  c AS (SELECT d, min(o) AS component_id FROM reach GROUP BY d)
SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles, c.component_id, n.doc_id = c.component_id AS kept FROM n JOIN c ON n.doc_id = c.d
"""
