import numpy as np
import pytest

from snapfacet.llm import simhash as S

from . import brute
from .conftest import SF_SMALL


def clusters(seed):
    rng = np.random.default_rng(seed)
    out = set()
    for _ in range(30):
        x = int(rng.integers(0, 2**63)) * 2 + int(rng.integers(0, 2))
        for _ in range(int(rng.integers(1, 30))):
            y = x
            for b in rng.choice(64, int(rng.integers(0, 6)), replace=False):
                y ^= 1 << int(b)
            out.add(y)
    return np.array(sorted(out), dtype=np.uint64)


@pytest.mark.parametrize("seed", range(5))
def test_trie_finds_the_components(seed):
    fp = clusters(seed)
    place = {int(x): i for i, x in enumerate(fp)}
    a, b = [], []
    for by in S.ROTATIONS:
        u, v = S._forest(fp, None, by, 0, 0, 4)
        a += [place[int(x)] for x in u]
        b += [place[int(x)] for x in v]
    got = S._components(len(fp), np.array(a, int), np.array(b, int))
    assert got.tolist() == brute.components([int(x) for x in fp], 4)


def test_trie_loses_no_link():
    """Without the known components the traversal lists every link."""
    fp = clusters(9)
    want = {(i, j) for i in range(len(fp)) for j in range(i + 1, len(fp)) if int(fp[i] ^ fp[j]).bit_count() <= 4}
    got = set()
    for by in S.ROTATIONS:
        turned = S._rotate(fp, by)
        order = np.argsort(turned)
        i, j = S._traverse(turned[order], np.arange(len(fp)), None, None, True, 0, 0, 4)
        got |= {tuple(sorted((int(order[x]), int(order[y])))) for x, y in zip(i, j)}
    assert got == want


@pytest.mark.parametrize("node_size", [S.NODE, 4])
def test_near_duplicates_are_brute_force(spark, small, odd, node_size):
    for docs in (small.limit(150), odd):
        rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        prints = [brute.fingerprint(t) for _, t in rows]
        label = brute.components(prints, 4)
        least = {}
        for (i, _), x in zip(rows, label):
            if i is not None:
                least[x] = min(least.get(x, i), i)
        want = sorted((str(i), f"{p:016x}", str(least.get(x))) for (i, _), p, x in zip(rows, prints, label))
        out = S.near_duplicates(docs, node_size=node_size).select("row.doc_id", "fingerprint", "component_id").collect()
        assert sorted((str(r[0]), r[1], str(r[2])) for r in out) == want


def test_chains_are_one_component(spark):
    links = spark.createDataFrame([(i + 1, i) for i in range(60)], "a long, b long")
    assert {r["root"] for r in S.components(links).collect()} == {0}


def test_empty_table(spark, odd):
    assert S.near_duplicates(odd.where("false")).count() == 0


def test_contract_columns(spark):
    q = S.op10_simhash_near_dedup(spark, SF_SMALL)
    assert q.columns == ["doc_id", "fingerprint", "component_id"]
