import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from snapfacet.llm import hard_negatives as H

from .conftest import SF_SMALL

NAN, INF = float("nan"), float("inf")


def mined(rows, anchor, positives, negatives, low, high):
    """Rows of the result for (id, vector, label), in plain Python; equal rows count each by itself."""
    good = [
        (i, [math.floor(256 * x) for x in v], b)
        for i, v, b in rows
        if i is not None and v is not None and b is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for n, (i, v, b) in enumerate(good):
        if not anchor(i):
            continue
        scores = [(-sum(x * y for x, y in zip(v, w)), j, m, c) for m, (j, w, c) in enumerate(good) if m != n]
        for s, j, _, _ in sorted(x for x in scores if x[3] == b)[:positives]:
            window = [x for x in scores if x[3] != b and low * -s <= 100 * -x[0] <= high * -s]
            out += [(i, j, r, x[1], -s, -x[0]) for r, x in enumerate(sorted(window)[:negatives], 1)]
    return sorted(out)


def frame(spark, rows):
    data = [(i, v, b, "x") for i, v, b in rows]
    return spark.createDataFrame(data, "id long, embedding array<double>, label int, score string")


def result(df, **kw):
    kw = {"positives": 2, "negatives": 3, **kw}
    return sorted(map(tuple, H.mine(df, F.col("id") % 5 == 0, **kw).collect()))


def made(seed, n, dims, labels=3):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(6, dims))
    return [(i, (centre[rng.integers(6)] + 0.4 * rng.normal(size=dims)).tolist(), int(rng.integers(labels))) for i in range(n)]


@pytest.mark.parametrize("dims, part, planes", [(64, H.PART, 8), (7, 9, 8), (70, 40, 4)])
def test_rows_are_brute_force(spark, dims, part, planes, monkeypatch):
    monkeypatch.setattr(H, "STEP", 16)
    rows = made(dims, 120, dims)
    got = result(frame(spark, rows), part=part)
    assert got == mined(rows, lambda i: i % 5 == 0, 2, 3, 30, 90) and got


def test_odd_rows(spark):
    v = [0.5, -0.25, 1.0]
    rows = [
        (0, v, 1),
        (0, v, 1),  # a row twice
        (5, v, 2),  # a tie of another label
        (5, [0.1, 0.2, 0.3], 1),
        (1, [0.4, -0.2, 0.9], 1),
        (2, [0.3, -0.2, 0.8], 2),
        (3, [0.3, -0.2, 0.8], 3),
        (-10, [0.3, -0.1, 0.7], 2),
        (10, [-0.5, 0.25, -1.0], 4),
        (20, [0.0, 0.0, 0.0], 2),
        (30, [], 2),
        (35, [1.0], 1),
        (40, None, 1),
        (45, v, None),
        (None, v, 1),
        (50, [None, 1.0, 1.0], 1),
        (55, [NAN, 1.0, 1.0], 1),
        (60, [INF, 1.0, 1.0], 1),
        (65, [-INF, 0.0, 0.0], 2),
    ]
    for part in (H.PART, 2):
        got = result(frame(spark, rows), part=part)
        assert got == mined(rows, lambda i: i % 5 == 0, 2, 3, 30, 90) and got


def test_empty_and_too_long(spark):
    rows = made(1, 10, 4)
    assert result(frame(spark, rows).where("false")) == []
    assert result(frame(spark, [(0, None, 1), (5, [1.0], None)])) == []
    assert result(frame(spark, [(0, [1.0], 1)])) == []
    with pytest.raises(Exception, match="too long"):
        result(frame(spark, [(0, [1e300, 1.0], 1), (5, [1.0, 1.0], 1)]))


@pytest.mark.parametrize("dims", [3, 64, 100])
def test_intervals_hold_every_score(dims):
    rng = np.random.default_rng(dims)
    x = np.floor(256 * rng.normal(size=(2000, dims)) * rng.choice([1e-3, 1, 100], (2000, 1)))
    x[:50] = np.round(x[50:100] * 0.9)  # near copies
    turn = H.rotation(dims)
    assert np.allclose(turn @ turn.T, np.eye(dims))
    code, aligned, rest, length = H.encode(x, turn)
    ones = np.bitwise_count(code).sum(axis=1, dtype=np.int64)
    skipped = 0
    for q in (*x[:60], np.zeros(dims)):
        low, high = H.Query(q, turn).interval(code, ones, aligned, rest, length)
        score = x @ q
        assert (low <= score).all() and (score <= high).all()
        skipped += int((high < np.sort(score)[-10]).sum())
    assert skipped > 0.2 * 61 * 2000


def test_rows_out_of_reach_are_not_scored(spark):
    """Two far groups: the other group's vectors are never read."""
    rng = np.random.default_rng(8)
    x = np.concatenate((np.full((500, 64), 100.0), np.full((500, 64), -100.0))) + rng.integers(-9, 9, (1000, 64))
    code, aligned, rest, length = H.encode(x, H.rotation(64))
    number = np.arange(1000)
    part = H.Part({"row": number, "id": number, "label": number * 0, "length": length, "aligned": aligned, "rest": rest, "code": code, "vector": x.astype("<i4")})
    _, high = part.intervals(H.Query(x[0], H.rotation(64)), slice(0, 1000))
    ((score, found),) = part.best(np.arange(1000), high, x[0].astype(np.int64), [(-(2**62), 2**62)], 5)
    exact = (x @ x[0]).astype(np.int64)
    assert score.tolist() == np.sort(exact)[::-1][:5].tolist() and part.scored <= 500


def test_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF_SMALL}/embeddings.parquet'")
    q = H.op12_hard_negatives(spark, SF_SMALL)
    assert q.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert [t for _, t in q.dtypes] == ["bigint", "bigint", "int", "bigint", "bigint", "bigint"]
    assert sorted(map(tuple, q.collect())) == sorted(con.execute(H.OP12_SQL).fetchall())
