import math
import re

import duckdb
import numpy as np
import pytest

from snapfacet.llm import lexical_search as L

from .conftest import SF_SMALL

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def ranked(docs, items, k):
    """Rows (item_id, rank, doc_id, score) by the contract's formula, in plain Python."""
    bags = [(i, terms(t)) for i, t in docs]
    held = [(i, t) for i, t in bags if t]
    n_docs, all_terms, df = len(held), sum(len(t) for _, t in held), {}
    for _, t in held:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    weight = {x: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for x, n in df.items()}
    out = []
    for item, text in items:
        scores = []
        for i, t in held:
            m, s = 75 + (25 * len(t) * n_docs) // all_terms, 0
            for x in terms(text):
                if tf := t.count(x):
                    s += weight[x] * ((10**9 * tf) // (1000 * tf + 12 * m))
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(str(item), r, str(i), -s) for r, (s, _, _, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def result(docs, items, **kw):
    rows = L.ranked_search(docs, items, **kw).collect()
    return sorted((str(r["item_id"]), r["rank"], str(r["doc_id"]), r["score"]) for r in rows)


ITEMS = [
    (1, "The QUICK brown fox"),
    (1, "the quick brown fox"),
    (2, None),
    (3, " ... "),
    (4, "alpha word fox fox fox"),
    (None, "é ü unknown"),
    (6, "nothing here occurs-anywhere zzzz"),
    (7, "a b. c,the THE"),
]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, score string")


@pytest.mark.parametrize("k, sizes", [(20, {}), (3, {}), (2, {"block_terms": 4, "block_entries": 7})])
def test_odd_rows_are_brute_force(spark, odd, items, k, sizes):
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    assert result(odd, items, k=k, **sizes) == ranked(rows, ITEMS, k)


def test_whole_tables_are_brute_force(spark, small):
    items = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    rows = [tuple(r) for r in small.select("doc_id", "text").collect()]
    asked = [tuple(r) for r in items.select("item_id", "text").collect()]
    want = ranked(rows, asked, 20)
    assert result(small.repartition(3), items) == want
    assert result(small, items, block_entries=900, block_terms=200) == want


def test_empty_tables(spark, odd, items):
    assert result(odd.where("false"), items) == []
    assert result(odd, items.where("false")) == []
    assert result(odd.where("text is null"), items) == []


def vectors(rng, rows, width, most):
    parts = [np.sort(rng.choice(width, int(rng.integers(1, most)), replace=False)) for _ in range(rows)]
    at = np.cumsum([0, *(len(p) for p in parts)])
    return L.Vectors(at, np.concatenate(parts), rng.integers(1, 1000, at[-1]))


def test_nodes_bound_what_is_below(monkeypatch):
    rng = np.random.default_rng(2)
    rows = vectors(rng, 300, 50, 12)
    dense = rng.integers(0, 9, 50)
    levels = L.hierarchy(rows, 4, 3, 50)
    assert len(levels[-1]) <= 3
    exact = rows.dot(dense, np.arange(300))
    assert exact.tolist() == [int((dense[rows.term[a:b]] * rows.value[a:b]).sum()) for a, b in zip(rows.at[:-1], rows.at[1:])]
    for level, size in zip(levels[1:], (4, 12, 36, 108)):
        bound = level.dot(dense, np.arange(len(level)))
        assert all(bound[i] >= exact[i * size : (i + 1) * size].max() for i in range(len(level)))
    some = np.array([7, 3, 250])
    assert rows.dot(dense, some).tolist() == exact[some].tolist()


def test_walk_is_exact_and_prunes():
    """Ten topics with terms of their own: an item needs the scores of few documents."""
    rng = np.random.default_rng(4)
    width, rows = 200, []
    for d in range(4000):
        t = d % 10 * 20 + np.sort(rng.choice(20, 6, replace=False))
        rows.append((t, rng.integers(1, 100, 6)))
    docs = L.Vectors(np.arange(0, 24001, 6), np.concatenate([t for t, _ in rows]), np.concatenate([v for _, v in rows]))
    block = [(i, np.sort(rng.choice(20, 4, replace=False)).astype(np.uint64) + np.uint64(i % 10 * 20), np.ones(4, np.int64)) for i in range(30)]
    block.append((30, np.arange(width, dtype=np.uint64), np.ones(width, np.int64)))
    s = L.Search(block, 5).weigh(4000, 24000, dict.fromkeys(range(width), 100))
    best, weakest = s.start()
    scored = s.walk(best, weakest, np.arange(4000), np.zeros(4000, bool), docs)
    assert scored < 0.5 * 4000 * 31
    for row, name in enumerate(s.names):
        dense = np.zeros(width, np.int64)
        dense[block[name][1].astype(int)] = s.weight[0]
        score = docs.dot(dense, np.arange(4000))
        order = np.lexsort((np.arange(4000), -score))[:5]
        assert best[row][1].tolist() == order.tolist() and best[row][0].tolist() == score[order].tolist()


def test_sql(spark):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_SMALL}/{name}.parquet'")
    q = L.op11_dual_tree_search(spark, SF_SMALL)
    assert q.columns == ["item_id", "rank", "doc_id", "score"]
    assert dict(q.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}
    assert sorted(map(tuple, q.collect())) == sorted(con.execute(L.OP11_SQL).fetchall())
