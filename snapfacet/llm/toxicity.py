"""Operator 2, toxicity by maximum-scoring segments.

Each token has a score: the log-odds of the token in toxic against other documents, with a
Dirichlet prior taken from the tokens of both (informative prior: a rare token is drawn to what
its share is over all), less a drift that makes the average token negative. Words are built on
stems, so a word's first characters count as tokens too (``STEMS``), and a word scores as the one
of them whose log-odds are the most certain (largest z-score). A linear scan finds
all maximal segments of a text, that is every passage whose score cannot be made larger by
growing or shrinking it. By the extreme-value law of such scores, segments of at least s in a
text of m tokens come about by chance about K*m*exp(-lambda*s) times; lambda solves
sum p*exp(lambda*score) = 1 over the tokens of the non-toxic rows and K is fitted to their best
segments. A text's chance value sums its segments' surprise, and a logistic curve learnt from
the training rows turns it and the share of toxic rows into a score from 0 to 1.

The model is fitted on a bounded sample: at most ``sample_rows`` labelled rows of each class,
those of the smallest hash of the id. Where that takes a class in part, its rows count in the
logistic curve by the inverse of the part taken, so a score is a chance under the share of toxic
rows among all training labels, whatever the size of the input. It keeps the ``max_terms`` tokens of the largest z-score;
other tokens score the drift. So what is broadcast has a proven bound. Scoring reads every text,
whole, without a shuffle. Labels, language, source and id are never inputs of a score.

Defined results: a null or empty text has no segments and gets the score of such texts; a row
without a label, or with a null one, is scored but not learnt from; several labels of an id count
as toxic if one is; without labelled rows of both classes every score is the share of toxic rows
(0.5 with none). Repeated rows are scored as often as they are there; other columns, whatever
their names, are in ``row``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package, table
from . import blocks as B
from . import words as W

#: Tokens: runs of ASCII letters, digits and all non-ASCII characters, A-Z lower-cased.
MIN_ROWS, MIN_Z = 3, 2.0
#: Lengths, in characters, of the word beginnings that are tokens beside the word.
STEMS = (4, 5)


@dataclass
class ToxicityModel:
    tokens: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))  # sorted hashes
    scores: np.ndarray = field(default_factory=lambda: np.zeros(0))
    certain: np.ndarray = field(default_factory=lambda: np.zeros(0))  # |z| of each
    drift: float = -1.0
    lam: float = 1.0
    k: float = 1.0
    slope: float = 0.0
    intercept: float = 0.0

    def token_scores(self, units: list[np.ndarray]) -> np.ndarray:
        """The score of each word from its units: itself and its beginnings."""
        out, best = np.full(len(units[0]), self.drift), np.zeros(len(units[0]))
        if len(self.tokens):
            for h in units:
                at = np.searchsorted(self.tokens, h)
                at[at == len(self.tokens)] = 0
                z = np.where(self.tokens[at] == h, self.certain[at], 0.0)
                better = z > best
                out[better], best[better] = self.scores[at[better]], z[better]
        return out

    def surprise(self, segments: list[float], n: int) -> float:
        """-ln of the chance of these segments in a text of n tokens, summed over the segments
        that are more than chance makes likely."""
        base = math.log(self.k * max(n, 1))
        return sum(x for x in (self.lam * s - base for s in segments) if x > 0)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.intercept + self.slope * np.log1p(x), -500, 500)))


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, one past last, score) in linear time: candidates
    are kept on a stack with the sums before and after them; a new positive token joins with
    the candidates that it makes larger."""
    sums = np.concatenate(([0.0], np.cumsum(scores)))
    found: list[tuple[int, int, float, float]] = []  # first, end, sum before, sum after
    below: list[int] = []  # for each candidate, the last one before it with a smaller left sum
    for i in np.flatnonzero(scores > 0).tolist():
        first, end, left, right = i, i + 1, float(sums[i]), float(sums[i + 1])
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= left:
                j = below[j]
            if j < 0 or found[j][3] >= right:
                del found[len(found) :], below[len(below) :]
                found.append((first, end, left, right))
                below.append(j)
                break
            first, left = found[j][0], found[j][2]
            del found[j:], below[j:]
    return [(a, b, r - x) for a, b, x, r in found]


def _beginnings(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """Hash of the first ``size`` characters of each word (0: the word is not longer)."""
    chars = np.flatnonzero((raw & 0xC0) != 0x80)
    cut = np.append(chars, len(raw))[np.minimum(np.searchsorted(chars, starts) + size, len(chars))]
    long = np.flatnonzero(cut < ends)
    out = np.zeros(len(starts), np.uint64)
    out[long] = W._hash(raw, starts[long], cut[long]) ^ W.mix(np.array([size], np.uint64))
    return out


def _texts(batch, column: str):
    """For each slice of a batch: its rows, the words before each row, and the units of the
    words (hashes of the word and of its beginnings)."""
    data, offsets = W.text_bytes(batch.column(column))
    for a, b in W.slices(offsets):
        lo, hi = int(offsets[a]), int(offsets[b])
        raw = W.LOWER[data[lo:hi]]
        rows, starts, ends, h = W.words(raw, offsets[a : b + 1] - lo, W.ALNUM)
        units = [h, *(_beginnings(raw, starts, ends, k) for k in STEMS)]
        yield a, b, np.searchsorted(rows, np.arange(b - a + 1), "left"), units


def _sampled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, rows: int) -> tuple[DataFrame, list[float]]:
    """Text and label (``_toxic``) of at most ``rows`` rows of each class, and how many labelled
    rows one of the clean and one of the toxic class stands for."""
    marks = labels.select(B.quoted(id_col).cast("long").alias("_key"), B.quoted(label_col).cast("int").alias("_toxic"))
    marks = marks.where("_key IS NOT NULL AND _toxic IS NOT NULL").groupBy("_key").agg(F.max("_toxic").alias("_toxic"))
    totals = {r["_toxic"]: r["count"] for r in marks.where("_toxic IN (0, 1)").groupBy("_toxic").count().collect()}
    stands = [max(1.0, totals.get(c, 0) / max(rows, 1)) for c in (0, 1)]
    order = (F.xxhash64("_key"), F.col("_key"))
    some = marks.where("_toxic = 1").orderBy(*order).limit(rows).union(marks.where("_toxic = 0").orderBy(*order).limit(rows))
    texts = docs.select(B.quoted(id_col).cast("long").alias("_key"), B.quoted(text_col).cast("string").alias("_text"))
    return texts.join(F.broadcast(some), "_key").select("_text", "_toxic"), stands  # 2 * rows ids at most


def _counts(sample: DataFrame) -> DataFrame:
    """token, toxic, clean: rows of either class that hold the token, added up in each batch
    first. Rows count, not occurrences, so a word that one text repeats has no more weight."""

    def run(batches):
        for batch in batches:
            toxic = batch.column("_toxic").to_numpy(zero_copy_only=False)
            for a, b, base, units in _texts(batch, "_text"):
                h = np.concatenate(units)
                row = np.tile(np.repeat(np.arange(b - a), np.diff(base)), len(units))[h != 0]
                h = h[h != 0]
                if not len(h):
                    continue
                order = np.lexsort((row, h))
                h, row = h[order], row[order]
                once = np.append(True, (h[1:] != h[:-1]) | (row[1:] != row[:-1]))
                h, bad = h[once], toxic[a + row[once]].astype(np.int64)
                first = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
                bad, total = np.add.reduceat(bad, first), np.diff(np.append(first, len(h)))
                cols = [pa.array(x.astype(np.int64), pa.int64()) for x in (h[first].view(np.int64), bad, total - bad)]
                yield pa.RecordBatch.from_arrays(cols, ["token", "toxic", "clean"])

    return sample.mapInArrow(run, "token long, toxic long, clean long").groupBy("token").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _lambda(scores: np.ndarray, share: np.ndarray) -> float:
    """The positive solution of sum share * exp(lambda * score) = 1."""
    low, high = 1e-6, 1.0
    value = lambda x: float((share * np.exp(np.minimum(x * scores, 700))).sum()) - 1
    while value(high) < 0 and high < 1e3:
        low, high = high, high * 2
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if value(mid) < 0 else (low, mid)
    return high


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of the weighted rows by Newton steps, with a light ridge on the slope."""
    w = np.zeros(2)
    design = np.column_stack((np.log1p(x), np.ones(len(x))))
    ridge = np.diag([1e-2, 1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        step = np.linalg.solve((design * (weight * p * (1 - p))[:, None]).T @ design + ridge, design.T @ (weight * (y - p)) - ridge @ w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample_rows: int = 10_000,
    max_terms: int = 50_000,
    prior_share: float = 0.01,
    drift: float = 2.0,
) -> ToxicityModel:
    """Learn from the rows of ``labels``; the caller leaves out those that are held out."""
    ship_package(docs.sparkSession)
    sample, stands = _sampled(docs, labels, id_col, text_col, label_col, sample_rows)
    counts = _counts(sample)
    tokens = counts.agg(F.sum("toxic"), F.sum("clean")).first()
    bad, good = (int(x or 0) for x in tokens)
    model = ToxicityModel()
    if not bad or not good:
        y = [r["_toxic"] for r in sample.select("_toxic").collect()]  # at most 2 * sample_rows
        toxic, clean = sum(y) * stands[1], (len(y) - sum(y)) * stands[0]
        share = min(max(toxic / (toxic + clean) if y else 0.5, 1e-6), 1 - 1e-6)
        model.intercept = math.log(share / (1 - share))
        return model
    # log-odds with prior counts in proportion to the token's share of all tokens
    prior = prior_share * (bad + good)
    a = (F.col("toxic") + F.col("clean")) * F.lit(prior_share)
    odds = lambda c, n: F.log(F.col(c) + a) - F.log(F.lit(n + prior) - F.col(c) - a)
    z = F.col("score") / F.sqrt(1 / (F.col("toxic") + a) + 1 / (F.col("clean") + a))
    terms = (
        counts.where(F.col("toxic") + F.col("clean") >= MIN_ROWS)
        .withColumn("score", odds("toxic", bad) - odds("clean", good))
        .withColumn("z", z)
        .where(F.abs("z") >= MIN_Z)
        .orderBy(F.desc(F.abs("z")), "token")
        .limit(max_terms)
        .select("token", "score", "clean", "z")
        .collect()
    )
    order = np.argsort(np.array([t["token"] for t in terms], np.int64).view(np.uint64))
    model.tokens = np.array([t["token"] for t in terms], np.int64).view(np.uint64)[order]
    model.scores = np.array([t["score"] for t in terms], float)[order] - drift
    model.certain = np.abs(np.array([t["z"] for t in terms], float)[order])
    model.drift = -drift
    clean = np.array([t["clean"] for t in terms], float)[order]
    share = np.append(clean, max(0.0, good - clean.sum())) / good
    # tokens that no clean row has are given half an occurrence
    share = np.maximum(share, 0.5 / good)
    model.lam = min(_lambda(np.append(model.scores, model.drift), share / share.sum()), 10.0)
    best = _best(sample, model)
    # K from the null rows: the mean of lambda * S - ln m is ln K plus Euler's constant
    null = [model.lam * r["best"] - math.log(r["n"]) for r in best if not r["toxic"] and r["best"] > 0]
    model.k = math.exp(min(max(float(np.median(null)) - 0.3665, -20.0), 20.0)) if null else 1.0
    rows = _surprises(sample, model)
    x = np.array([r["surprise"] for r in rows])
    y = np.array([float(r["toxic"]) for r in rows])
    weight = np.where(y > 0, stands[1], stands[0])
    model.slope, model.intercept = _logistic(x, y, weight * (len(y) / weight.sum()))
    return model


def _best(sample: DataFrame, model: ToxicityModel) -> list:
    """Number of tokens and best segment score of each row of the sample."""

    def run(batches):
        for batch in batches:
            toxic = batch.column("_toxic").to_pylist()
            for a, b, base, units in _texts(batch, "_text"):
                scores = model.token_scores(units)
                best = [max((s for _, _, s in maximal_segments(scores[base[i] : base[i + 1]])), default=0.0) for i in range(b - a)]
                cols = [toxic[a:b], np.maximum(1, np.diff(base)), best]
                types = (pa.int32(), pa.int64(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["toxic", "n", "best"])

    return sample.mapInArrow(run, "toxic int, n long, best double").collect()


def _surprises(sample: DataFrame, model: ToxicityModel) -> list:
    """One number for each row of the sample, as ``score`` adds it up: over all its segments."""

    def run(batches):
        for batch in batches:
            toxic = batch.column("_toxic").to_pylist()
            for a, b, base, units in _texts(batch, "_text"):
                scores = model.token_scores(units)
                each = [maximal_segments(scores[base[i] : base[i + 1]]) for i in range(b - a)]
                surprise = [model.surprise([s for _, _, s in found], int(base[i + 1] - base[i])) for i, found in enumerate(each)]
                yield pa.RecordBatch.from_arrays([pa.array(toxic[a:b], pa.int32()), pa.array(surprise, pa.float64())], ["toxic", "surprise"])

    return sample.mapInArrow(run, "toxic int, surprise double").collect()


PASSAGES = T.ArrayType(T.StructType().add("start", "long").add("end", "long").add("score", "double").add("e_value", "double"))


def score(docs: DataFrame, model: ToxicityModel, text_col: str = "text", max_e: float = 0.05) -> DataFrame:
    """Per row of ``docs``: ``row`` (its other columns), ``text``, ``score``, and ``passages``:
    the segments (token numbers) expected by chance at most ``max_e`` times in such a text."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for batch in batches:
            surprise, passages = [], []
            for a, b, base, units in _texts(batch, "_text"):
                scores = m.token_scores(units)
                for i in range(b - a):
                    n = int(base[i + 1] - base[i])
                    found = maximal_segments(scores[base[i] : base[i + 1]])
                    surprise.append(m.surprise([s for _, _, s in found], n))
                    e = [(x, y, s, m.k * n * math.exp(-m.lam * s)) for x, y, s in found]
                    passages.append([{"start": x, "end": y, "score": s, "e_value": v} for x, y, s, v in e if v <= max_e])
            if batch.num_rows:
                kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("e_value", pa.float64())]))
                cols = [batch.column("row"), batch.column("_text"), pa.array(m.probability(np.array(surprise))), pa.array(passages, kind)]
                yield pa.RecordBatch.from_arrays(cols, ["row", "text", "score", "passages"])

    row = F.struct(*(B.quoted(c) for c in docs.columns if c != text_col))
    d = docs.select(row.alias("row"), B.quoted(text_col).cast("string").alias("_text"))
    schema = T.StructType().add("row", d.schema["row"].dataType).add("text", "string").add("score", "double").add("passages", PASSAGES)
    return d.mapInArrow(run, schema)


def held_out(id_col: str = "doc_id"):
    """Rows that are never learnt from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(B.quoted(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


#: A score of at least this is predicted toxic.
THRESHOLD = 0.3


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    """Contract query: learnt from the labelled rows that are not held out, all ``documents``."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = score(docs, fit(docs, labels.where(~held_out())))
    return scored.select(
        "row.doc_id",
        F.coalesce(F.crc32(F.col("row.doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        F.size("passages").alias("n_passages"),
    )
