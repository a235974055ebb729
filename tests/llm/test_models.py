import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapfacet.llm import interpolation as I
from snapfacet.llm import toxicity as X

from . import brute
from .conftest import SF_SMALL


def best_segments(s):
    """By definition: the best segment, then those left and right of it."""
    c = np.concatenate(([0], np.cumsum(s)))

    def rec(a, b):
        best = None
        for i in range(a, b):
            for j in range(i + 1, b + 1):
                if c[j] - c[i] > 1e-12 and (best is None or c[j] - c[i] > best[2] + 1e-12):
                    best = (i, j, c[j] - c[i])
        return [] if best is None else [*rec(a, best[0]), best, *rec(best[1], b)]

    return rec(0, len(s))


def test_maximal_segments():
    rng = np.random.default_rng(0)
    for _ in range(200):
        s = rng.normal(-0.3, 1, int(rng.integers(0, 22)))
        got, want = X.maximal_segments(s), best_segments(s)
        assert [g[:2] for g in got] == [w[:2] for w in want]
        assert np.allclose([g[2] for g in got], [w[2] for w in want])
    assert X.maximal_segments(np.array([])) == []


def toxic_corpus(spark, n=900):
    rng = np.random.default_rng(3)
    bad = ["scum", "idiot", "vilify"]
    rows, marks = [], []
    for i in range(n):
        words = [f"w{int(x)}" for x in rng.integers(0, 300, 30)]
        toxic = int(i % 5 == 0)
        if toxic:
            for p in rng.choice(30, 2, replace=False):
                words[p] = bad[int(rng.integers(0, 3))] + ("" if i % 2 else f"x{i}")
        rows.append((i, " ".join(words)))
        marks.append((i, toxic))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, toxic int")


def test_toxic_documents_are_found_and_held_out_rows_unseen(spark):
    docs, labels = toxic_corpus(spark)
    model = X.fit(docs, labels.where(~X.held_out()))
    out = X.score(docs, model).select("row.doc_id", "score", "passages").join(labels, "doc_id").where(X.held_out()).collect()
    right = sum((r["score"] >= X.THRESHOLD) == bool(r["toxic"]) for r in out)
    assert right >= 0.95 * len(out)
    assert sum(bool(r["passages"]) for r in out if r["toxic"]) >= 0.9 * sum(r["toxic"] for r in out)
    # other labels of held-out rows change nothing
    flipped = labels.withColumn("toxic", F.when(X.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = X.fit(docs, flipped.where(~X.held_out()))
    assert (again.tokens == model.tokens).all() and np.allclose(again.scores, model.scores)


def plain_scores(rows, marks):
    """The score of each text by the method, in plain Python, for fewer rows than a sample has."""
    names = [brute.ALNUM.findall(brute.lower(t)) for _, t in rows]
    units = lambda w: [("", w), *((k, w[:k]) for k in X.STEMS if len(w) > k)]
    toxic, clean = Counter(), Counter()
    for (i, _), words in zip(rows, names):
        for u in {u for w in words for u in units(w)}:
            (toxic if marks[i] else clean)[u] += 1
    bad, good = sum(toxic.values()), sum(clean.values())
    prior, drift, table = 0.01 * (bad + good), 2.0, {}
    for u in toxic | clean:
        t, c, a = toxic[u], clean[u], 0.01 * (toxic[u] + clean[u])
        odds = math.log(t + a) - math.log(bad + prior - t - a) - math.log(c + a) + math.log(good + prior - c - a)
        z = odds / math.sqrt(1 / (t + a) + 1 / (c + a))
        if t + c >= X.MIN_ROWS and abs(z) >= X.MIN_Z:
            table[u] = (odds - drift, abs(z), c)

    def of(word):
        known = [table[u] for u in units(word) if u in table]
        return max(known, key=lambda k: k[1])[0] if known else -drift

    share = np.array([*(max(c, 0.5) for _, _, c in table.values()), max(0.5, good - sum(c for _, _, c in table.values()))], float)
    share /= share.sum()
    value = lambda x: float((share * np.exp(x * np.array([*(s for s, _, _ in table.values()), -drift]))).sum())
    low, high = 1e-6, 10.0
    for _ in range(200):
        low, high = (low, (low + high) / 2) if value((low + high) / 2) >= 1 else ((low + high) / 2, high)
    segments = [[s for _, _, s in best_segments(np.array([of(w) for w in words]))] for words in names]
    null = [high * max(s) - math.log(len(w)) for (i, _), s, w in zip(rows, segments, names) if s and not marks[i]]
    assert null
    k = math.exp(float(np.median(null)) - 0.3665)
    x = [math.log1p(sum(max(0.0, high * s - math.log(k * max(len(w), 1))) for s in row)) for row, w in zip(segments, names)]
    y, slope, cut = [float(marks[i]) for i, _ in rows], 0.0, 0.0
    for _ in range(200):  # Newton steps with the ridge on the slope
        p = [1 / (1 + math.exp(-slope * a - cut)) for a in x]
        g = (sum(a * (q - b) for a, q, b in zip(x, p, y)) + 1e-2 * slope, sum(q - b for q, b in zip(p, y)) + 1e-6 * cut)
        w = [q * (1 - q) for q in p]
        h = (sum(a * a * v for a, v in zip(x, w)) + 1e-2, sum(a * v for a, v in zip(x, w)), sum(w) + 1e-6)
        det = h[0] * h[2] - h[1] ** 2
        step = ((h[2] * g[0] - h[1] * g[1]) / det, (h[0] * g[1] - h[1] * g[0]) / det)
        slope, cut = slope - max(-5, min(5, step[0])), cut - max(-5, min(5, step[1]))
    return [1 / (1 + math.exp(-slope * a - cut)) for a in x]


def test_scores_are_plain_pythons(spark):
    docs, labels = toxic_corpus(spark, 240)
    # a long row with more than 64 bad passages, far apart
    long = " ".join(f"scum idiot {' '.join(f'w{(7 * i + j) % 300}' for j in range(9))}" for i in range(80))
    docs = docs.union(spark.createDataFrame([(1000, long)], docs.schema))
    labels = labels.union(spark.createDataFrame([(1000, 1)], labels.schema))
    labels = labels.withColumn("toxic", F.when(F.col("doc_id") % 30 == 0, 0).otherwise(F.col("toxic")))  # bad words in clean rows
    rows = sorted(tuple(r) for r in docs.collect())
    marks = {r[0]: r[1] for r in labels.collect()}
    model = X.fit(docs, labels)
    got = {r[0]: r[1] for r in X.score(docs, model).select("row.doc_id", "score").collect()}
    want = plain_scores(rows, marks)
    assert model.lam < 10 and max(abs(got[i] - w) for (i, _), w in zip(rows, want)) < 1e-6


def test_toxicity_odd_rows(spark, odd):
    docs, labels = toxic_corpus(spark, 300)
    model = X.fit(docs, labels)
    out = X.score(odd, model).collect()
    assert len(out) == odd.count() and all(0 <= r["score"] <= 1 for r in out)
    assert X.score(odd.where("false"), model).count() == 0
    for marks in (labels.where("false"), labels.where("toxic = 1"), labels.withColumn("toxic", F.lit(None).cast("int"))):
        scores = {r["score"] for r in X.score(odd, X.fit(docs, marks)).collect()}
        assert len(scores) == 1


def test_sample_size_does_not_move_the_scores(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))

    def rates(rows):
        model = X.fit(docs, labels.where(~X.held_out()), sample_rows=rows)
        return X.score(docs, model).agg(F.avg((F.col("score") >= X.THRESHOLD).cast("int")), F.avg("score")).first()

    assert np.allclose(rates(300), rates(10**6), rtol=0.1)  # 300 of some 3000 clean rows
    # without words the score is the share of toxic rows, also of a sample
    rows = spark.range(100).select(F.col("id").alias("doc_id"), F.lit("").alias("text"), (F.col("id") < 10).cast("int").alias("toxic"))
    model = X.fit(rows.drop("toxic"), rows, sample_rows=10)
    assert np.allclose(model.probability(np.zeros(1)), 0.1)


def test_op2_contract(spark):
    q = X.op2_toxicity(spark, SF_SMALL)
    assert q.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    rows = q.collect()
    assert len(rows) == spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in rows)


def reference_scores(rows, trained, model):
    split = [[*brute.WORD.findall(brute.lower(t)), None] for _, t in rows]
    one, two, three, n = Counter(), Counter(), Counter(), 0
    for w, t in zip(split, trained):
        if t:
            s = ["<s>", "<s>", *w]
            n += 1
            for k in range(2, len(s)):
                one[s[k]] += 1
                two[s[k - 1], s[k]] += 1
                three[s[k - 2], s[k - 1], s[k]] += 1
    total, types, out = sum(one.values()), len(one), []
    for w, t in zip(split, trained):
        s, score = ["<s>", "<s>", *w], 0.0
        for k in range(2, len(s)):
            a, b, c = s[k - 2 : k + 1]
            n1, n2 = (n if b == "<s>" else one[b]), (n if b == "<s>" else two[a, b])
            bucket = I.BUCKETS + int(math.log2(n2)) if n2 else 1 + int(math.log2(n1)) if n1 else 0
            lam = model.weights[bucket]
            parts = (three[a, b, c] / n2 if n2 else 0, two[b, c] / n1 if n1 else 0, one[c] / total if total else 0, 1 / (types + 1))
            score += math.log10(sum(x * y for x, y in zip(lam, parts)))
        base = sum(math.log10((one[x] + 1) / (total + types + 1)) for x in w)
        out.append((not t, len(w), sum(one[x] > 0 for x in w), total, base, score))
    return out


@pytest.mark.parametrize("chunk", [None, 30_000])
def test_interpolation_is_brute_force(small, odd, chunk):
    for docs in (small, odd):
        train = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2
        counted, kind = I.ngram_counts(docs, train, chunk=chunk, per_bucket=chunk)
        counted = counted.checkpoint()
        model = I.learn(counted)
        got = I.score(counted, kind, model).select("row.doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()
        rows = docs.select("doc_id", "text", F.coalesce(train, F.lit(True))).collect()
        want = reference_scores([r[:2] for r in rows], [r[2] for r in rows], model)
        order = lambda x: (str(x[0]), *x[1:5], round(x[5], 4))
        got = sorted((tuple(r) for r in got), key=order)
        want = sorted(((r[0], *w) for r, w in zip(rows, want)), key=order)
        assert [g[:5] for g in got] == [w[:5] for w in want]
        assert np.allclose([g[5:] for g in got], [w[5:] for w in want], rtol=1e-6)
        assert np.allclose(model.weights.sum(axis=1), 1)


def test_interpolation_beats_the_base_on_held_out_rows(spark):
    rows = I.op9_deleted_interpolation(spark, "/root/testdata/sf0.01").where("held_out").collect()
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_interpolation_without_training_rows(odd):
    out = I.interpolated_scores(odd, F.lit(False)).collect()
    assert len(out) == odd.count() and all(r["score"] == 0 and r["train_tokens"] == 0 for r in out)
    assert I.interpolated_scores(odd.where("false"), F.lit(True)).count() == 0
