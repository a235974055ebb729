import duckdb
import numpy as np
import pyarrow as pa
import pytest

from snapfacet.llm import minhash as M

from . import brute
from .conftest import SF_SMALL


def shingle_set(text, k):
    w = brute.WORD.findall(brute.lower(text))
    return {tuple(w[p : p + k]) for p in range(max(1, len(w) - k + 1))} if w else set()


def linked(rows, k, top):
    """Smallest position reachable over links of at least ``top`` hundredths, for rows (id, text)."""
    sets = [shingle_set(t, k) for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= top * len(a | sets[j]):
                x, y = root(i), root(j)
                label[max(x, y)] = min(x, y)
    label = [root(i) for i in range(len(rows))]
    least = {}
    for (i, _), x in zip(rows, label):
        if i is not None:
            least[x] = min(least.get(x, i), i)
    return sorted((str(i), len(s), str(least.get(x)), i == least.get(x)) for (i, _), s, x in zip(rows, sets, label))


def result(docs, **kw):
    out = M.near_duplicates(docs, shingle_words=3, similarity=0.85, **kw)
    return sorted((str(r[0]), r[1], str(r[2]), r[3]) for r in out.select("row.doc_id", "n_shingles", "component_id", "kept").collect())


def family(rng, words, copies, changes):
    """Copies of one text, each with some words replaced; neighbours in the chain stay close."""
    base, out = [f"w{i}" for i in rng.integers(0, 5000, words)], []
    for _ in range(copies):
        w = list(base)
        for p in rng.choice(words, int(rng.integers(0, changes + 1)), replace=False):
            w[p] = f"x{rng.integers(0, 10**6)}"
        out.append(" ".join(w))
        if rng.random() < 0.2:
            base = w
    return out


def test_shingles_are_sets(odd):
    texts = [t for _, t in odd.select("doc_id", "text").collect()] + ["a b", "A  B", "b a", "a", "a b a b a b a b"]
    x, at = M.shingles(pa.array(texts), 3)
    sets = [shingle_set(t, 3) for t in texts]
    assert np.diff(at).tolist() == [len(s) for s in sets]
    for i in range(len(texts)):
        for j in range(len(texts)):
            assert len(np.intersect1d(x[at[i] : at[i + 1]], x[at[j] : at[j + 1]])) == len(sets[i] & sets[j])


def test_signature_is_circulant(monkeypatch):
    """Every coordinate is the least value of one permutation, read with a shift; slabs don't matter."""
    rng = np.random.default_rng(3)
    x = rng.integers(0, 2**63, 500).astype(np.uint64)
    at = np.array([0, 0, 120, 121, 121, 500, 500])
    got = M.signatures(x, at, 12)
    monkeypatch.setattr(M, "SLAB", 37)
    assert (M.signatures(x, at, 12) == got).all()
    for r in range(len(at) - 1):
        place = M._permute(x[at[r] : at[r + 1]], M.SIGMA)
        want = [int(M._permute(place - np.uint64(k), M.PI).min()) if len(place) else 2**64 - 1 for k in range(12)]
        assert got[r].tolist() == want


def test_equal_coordinates_estimate_the_similarity():
    rng = np.random.default_rng(5)
    x = rng.integers(0, 2**63, 3000).astype(np.uint64)
    both, size = 1700, 160  # 1700 of 3000 in both: similarity 0.567
    sets = np.concatenate((x[:2350], x[650:]))
    a, b = M.signatures(sets, np.array([0, 2350, 4700]), size)
    assert abs((a == b).mean() - both / 3000) < 0.15
    assert M.least_matches(160, 0.85) < 115


def links_of(texts, one_block):
    """Components from ``spanning_links``, with all texts in one block or in two."""
    x, at = M.shingles(pa.array(texts), 3)
    sets = M.Sets([x[a:b] for a, b in zip(at[:-1], at[1:])])
    sign = (M.signatures(x, at, 160) & np.uint64(255)).astype(np.uint8)
    label, every = np.arange(len(texts)), np.arange(len(texts))
    odd_, even = every[1::2], every[::2]
    blocks = [(every, every)] if one_block else [(odd_, odd_), (even, even), (odd_, even)]
    for a, b in blocks:
        found = M.spanning_links(sign, label, sets, a, a if a is b else b, M.least_matches(160, 0.85), 8500)
        forest = M._forest(found, label)
        assert len(forest) < len(texts)
        if forest:
            i, j = np.array(forest).T
            label = M._components(len(texts), label[i], label[j])[label]
    return label.tolist()


@pytest.mark.parametrize("one_block", [True, False])
def test_blocks_find_the_components(one_block):
    rng = np.random.default_rng(2)
    texts = [t for n in (40, 25, 9) for t in family(rng, 90, n, 5)]
    got = links_of(texts, one_block)
    want = linked(list(enumerate(texts)), 3, 85)
    assert sorted((str(i), str(x)) for i, x in enumerate(got)) == sorted((w[0], w[2]) for w in want)
    assert 3 < len(set(got)) < 40


@pytest.mark.parametrize("block", [M.BLOCK, 3])
def test_links_are_brute_force(spark, small, odd, block, monkeypatch):
    if block == 3:
        monkeypatch.setattr(M, "PIVOTS", 2)
    rng = np.random.default_rng(7)
    texts = [t for n in (12, 7, 2) for t in family(rng, 120, n, 6)]
    made = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for docs in (made, odd) if block == 3 else (made, odd, small):
        rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        assert result(docs, block=block) == linked(rows, 3, 85)


def test_empty_table(spark, odd):
    assert result(odd.where("false")) == []
    only = odd.where("text is null or trim(text) = ''")
    assert {r[1] for r in result(only)} == {0}


def test_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_SMALL}/documents.parquet'")
    q = M.op13_minhash_near_dedup(spark, SF_SMALL)
    assert q.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted(map(tuple, q.collect())) == sorted(con.execute(M.OP13_SQL).fetchall())
