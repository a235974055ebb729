"""Full-text index and BM25 scoring: X1-X7, A7.

Build (X1): every row's text columns are joined, lower-cased, stripped of accents and split
at non-letters -- native Column expressions (X2). Optional English stop words (X3) are an
``IN``-set filter (fixed size, no join) and the optional English Snowball stemmer (X4) is an Arrow UDF
applied to the *distinct vocabulary only* and joined back to the postings.

Stored layout (Parquet, one folder per table):

* ``postings(term, id, tf, dl)``: one row per (term, document); the document length ``dl``
  is kept on the posting, so scoring needs no join with a document table. Written
  range-partitioned and sorted by ``term``: a query's ``term IN (...)`` reads only the row
  groups whose min/max cover its terms.
* ``terms(term, df)``: document frequency per term.
* ``corpus(n_docs, avgdl)``: one row.

The token stream is never shuffled: a document is one row, so its term frequencies are
counted inside the row (sorted token array, lengths of runs of equal tokens) and the
(term, tf) pairs are exploded -- building postings needs no exchange at all. Document
frequency per term is a partial aggregate, so a term present in a third of all documents
costs one partial row per task.

Score (X5): ``sum over query terms of idf * tf*(k1+1) / (tf + k1*(1-b+b*dl/avgdl))`` with
``idf = ln(1 + (N-df+0.5)/(df+0.5))``; rows without any query term get no score (F15).
"""

from __future__ import annotations

import math
import re
import unicodedata
from dataclasses import dataclass
from typing import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.common import col
from ..session import scratch

K1 = 1.2
B = 0.75
TOKEN_SPLIT = "[^a-z]+"
#: Postings that one task sorts and writes: some 200 MB of its memory, whatever the size of the table.
ROWS_PER_FILE = 2_000_000


def _accent_table() -> tuple[str, str]:
    """Letters with diacritics -> their base letter, built from the Unicode decomposition
    of the Latin blocks (U+00C0..U+024F): a letter whose canonical decomposition is an
    ASCII letter followed by combining marks maps to that letter."""
    src, dst = [], []
    for cp in range(0x00C0, 0x0250):
        ch = chr(cp)
        d = unicodedata.normalize("NFD", ch)
        if len(d) > 1 and d[0].isascii() and d[0].isalpha() and all(unicodedata.combining(x) for x in d[1:]):
            src.append(ch)
            dst.append(d[0])
    return "".join(src), "".join(dst)


ACCENTS_FROM, ACCENTS_TO = _accent_table()


def strip_accents(c: Column) -> Column:
    return F.translate(c, ACCENTS_FROM, ACCENTS_TO)


def normalized_text(columns: Sequence[str]) -> Column:
    """X2 (before splitting): joined, lower-cased, accents stripped."""
    joined = F.lower(F.concat_ws(" ", *[col(c) for c in columns]))
    # looking up every character is half of the work on a text; one of single-byte characters has no accents
    return F.when(F.octet_length(joined) == F.length(joined), joined).otherwise(strip_accents(joined))


def token_array(columns: Sequence[str]) -> Column:
    """Array of tokens (letters a-z only), empty parts removed."""
    return F.filter(F.split(normalized_text(columns), TOKEN_SPLIT), lambda t: t != F.lit(""))


def english_stop_words() -> list[str]:
    """Spark's own English stop-word list."""
    from pyspark.ml.feature import StopWordsRemover

    return [w for w in StopWordsRemover.loadDefaultStopWords("english") if re.fullmatch("[a-z]+", w)]


def read_stop_words(spark: SparkSession, path: str, most: int = 10_000) -> list[str]:
    """A list of one's own, a word or line of words per line of text files, folded as the index folds texts. A list is
    small by nature (it is a filter on every token): one of more than ``most`` words is an error."""
    lines = spark.read.text(path).select(strip_accents(F.lower("value")).alias("t"))
    words = lines.select(F.explode(F.split("t", TOKEN_SPLIT)).alias("w")).where("w <> ''").distinct().limit(most + 1).collect()
    if len(words) > most:
        raise ValueError(f"more than {most} stop words")
    return sorted(r["w"] for r in words)


def _stem_batch(words: pd.Series) -> pd.Series:
    from ..functions.stemmer import stem

    return words.map(stem)


_STEM_UDF = []


def porter_stem(c: Column) -> Column:
    """X4 as an Arrow-batched UDF. Marked nondeterministic on purpose: it keeps Catalyst
    from copying a filter on the stem (e.g. the query terms) below the vocabulary into the
    token stream, which would run Python once per token instead of once per distinct
    term. Created on first use (a UDF needs a running session)."""
    from ..session import ship_package

    ship_package(SparkSession.getActiveSession())
    if not _STEM_UDF:
        _STEM_UDF.append(F.pandas_udf(_stem_batch, T.StringType()).asNondeterministic())
    return _STEM_UDF[0](c)


def analyze_query(text: str, stop_words: Sequence[str] = (), stemmer: bool = False) -> list[str]:
    """The query side of X2-X4 (a short string, so done in Python): same rule as the index."""
    table = str.maketrans(ACCENTS_FROM, ACCENTS_TO)
    terms = [t for t in re.split(TOKEN_SPLIT, text.lower().translate(table)) if t]
    stops = set(stop_words)
    terms = [t for t in terms if t not in stops]
    if stemmer:
        from ..functions.stemmer import stem

        terms = [stem(t) for t in terms]
    return list(dict.fromkeys(terms))


@dataclass
class TextIndex:
    postings: DataFrame  # term, id, tf, dl
    terms: DataFrame  # term, df
    n_docs: int
    avgdl: float
    id_col: str = "id"
    stop_words: tuple = ()
    stemmer: bool = False
    n_postings: int | None = None
    unmerged: DataFrame | None = None  # postings in which stems of different words of a document are rows of their own

    def save(self, path: str, rows_per_file: int = ROWS_PER_FILE) -> "TextIndex":
        """Write the three tables. The number of postings (before stemming, where words of a document may fall together) decides into how many
        files of ``rows_per_file`` they are sorted by (term, id). Not by term alone: a term held by a third of
        all documents is then spread over many writer tasks. Stems of a document meet in the task that writes them: they need no
        exchange of their own. The terms are counted from the stored postings, and stored in order."""
        spark = self.postings.sparkSession
        rows = self.postings.count() if self.n_postings is None else self.n_postings
        loose = self.postings if self.unmerged is None else self.unmerged
        spread = loose.repartitionByRange(max(1, math.ceil(rows / rows_per_file)), "term", self.id_col)
        if self.unmerged is not None:
            spread = merged_stems(spread, self.id_col)
        spread.sortWithinPartitions("term", self.id_col).write.mode("overwrite").parquet(f"{path}/postings")
        stored = spark.read.parquet(f"{path}/postings")
        terms = stored.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        terms.orderBy("term").write.mode("overwrite").parquet(f"{path}/terms")
        meta = spark.createDataFrame(
            [(self.n_docs, float(self.avgdl), self.id_col, list(self.stop_words), self.stemmer)],
            "n_docs long, avgdl double, id_col string, stop_words array<string>, stemmer boolean",
        )
        meta.coalesce(1).write.mode("overwrite").parquet(f"{path}/corpus")
        return TextIndex.load(spark, path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "TextIndex":
        m = spark.read.parquet(f"{path}/corpus").first()
        return TextIndex(
            postings=spark.read.parquet(f"{path}/postings"),
            terms=spark.read.parquet(f"{path}/terms"),
            n_docs=int(m["n_docs"]),
            avgdl=float(m["avgdl"]),
            id_col=m["id_col"],
            stop_words=tuple(m["stop_words"] or ()),
            stemmer=bool(m["stemmer"]),
        )


def with_term_counts(df: DataFrame, tokens: Column, out: str = "counts", length: str = "dl") -> DataFrame:
    """Per-row term frequencies without a shuffle: sort the row's tokens, find where each
    run of equal tokens ends, and pair every distinct term with its run length. Adds
    ``out`` (array<struct<term, tf>>) and ``length`` (number of tokens).

    The sorted array and the run ends are their own columns (separate projections): the
    lambdas below read them by position, and an inlined ``sort_array`` would be re-run for
    every element."""
    keep = [c for c in df.columns if c not in (out, length)]
    a, e = F.col("__sorted"), F.col("__ends")
    staged = df.select(*keep, F.sort_array(tokens).alias("__sorted"))
    staged = staged.select(*keep, "__sorted", F.size(a).alias("__n"))
    n = F.col("__n")
    ends = F.when(
        n > 0,
        F.filter(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: (i == n) | (F.element_at(a, i) != F.element_at(a, i + 1))),
    ).otherwise(F.array().cast("array<int>"))
    staged = staged.select(*keep, "__sorted", "__n", ends.alias("__ends"))

    def pair(end, k):  # k: 0-based position in ``__ends``; the previous run ended at ends[k]
        start = F.when(k == 0, F.lit(0)).otherwise(F.element_at(e, k))
        return F.struct(F.element_at(a, end).alias("term"), (end - start).cast("long").alias("tf"))

    return staged.select(*keep, F.transform(e, pair).alias(out), n.cast("long").alias(length))


def postings_frame(
    df: DataFrame,
    id_col: str,
    columns: Sequence[str],
    stop_words: Sequence[str] = (),
    stemmer: bool = False,
) -> DataFrame:
    """(term, id, tf, dl) without corpus statistics (lazy).

    Every document is one row, so its term counts are computed inside the row
    (``term_counts``) and exploded: building postings moves no data between tasks. Only the
    optional stemming re-aggregates (stems of different words of one document merge)."""
    return exploded_counts(counted_documents(df, id_col, columns, stop_words), id_col, stemmer)


def counted_documents(df: DataFrame, id_col: str, columns: Sequence[str], stop_words: Sequence[str] = ()) -> DataFrame:
    """One row per document: id, ``c`` (its terms with their counts) and ``dl`` (its length)."""
    sw = list(stop_words or ())
    words = F.split(normalized_text(columns), TOKEN_SPLIT)
    keep = (lambda t: (t != F.lit("")) & ~t.isin(sw)) if sw else (lambda t: t != F.lit(""))
    return with_term_counts(df.select(id_col, F.filter(words, keep).alias("toks")), F.col("toks"), "c", "dl")


def exploded_counts(docs: DataFrame, id_col: str, stemmer: bool = False) -> DataFrame:
    """(term, id, tf, dl) of counted documents."""
    # explode_outer + an explicit null filter: for a plain explode Spark infers a
    # ``size(c) > 0`` filter and pushes it below the projections, re-evaluating the whole
    # counting expression (sort included) inside it.
    post = (
        docs.select(id_col, "dl", F.explode_outer("c").alias("p"))
        .where(F.col("p").isNotNull())
        .select(F.col("p.term").alias("term"), id_col, F.col("p.tf").alias("tf"), "dl")
    )
    if stemmer:
        post = merged_stems(stemmed(post, id_col), id_col)
    return post.select("term", id_col, "tf", "dl")


def stemmed(post: DataFrame, id_col: str) -> DataFrame:
    """(term, id, tf, dl) with the stem of each word in its place; a document may have a stem more than once."""
    stems = post.select("term").distinct().select("term", porter_stem(F.col("term")).alias("stem"))
    return post.join(stems, "term").select(F.col("stem").alias("term"), id_col, "tf", "dl")


def merged_stems(post: DataFrame, id_col: str) -> DataFrame:
    return post.groupBy("term", id_col, "dl").agg(F.sum("tf").alias("tf")).select("term", id_col, "tf", "dl")


def build_text_index(
    df: DataFrame,
    id_col: str,
    columns: Sequence[str],
    stop_words: Sequence[str] | None = None,
    stemmer: bool = False,
) -> TextIndex:
    """Build the index. ``stop_words=None`` -> none; pass ``english_stop_words()``
    for the reference's setting.

    The texts are read once: their terms, counted per document, are staged in the shared scratch folder. Corpus statistics
    are one aggregate over the staged lengths, postings come from the staged counts, however often they are asked for."""
    sw = tuple(stop_words or ())
    spark, staged = df.sparkSession, scratch(df.sparkSession, "counted")
    counted_documents(df, id_col, columns, sw).write.parquet(staged)
    docs = spark.read.parquet(staged)
    loose = exploded_counts(docs, id_col)
    if stemmer:
        loose = stemmed(loose, id_col)
    post = merged_stems(loose, id_col) if stemmer else loose
    terms = post.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    stats = docs.agg(F.count(F.lit(1)).alias("n"), F.avg("dl").alias("avgdl"), F.coalesce(F.sum(F.size("c")), F.lit(0)).alias("p")).first()
    return TextIndex(post, terms, int(stats["n"]), float(stats["avgdl"] or 0.0), id_col, sw, stemmer, int(stats["p"]), loose if stemmer else None)


def bm25_scores(index: TextIndex, query: str, k1: float = K1, b: float = B, score_col: str = "score") -> DataFrame:
    """(id, score) for every row holding at least one query term."""
    q = analyze_query(query, index.stop_words, index.stemmer)
    spark = index.postings.sparkSession
    if not q:
        return spark.createDataFrame([], f"{index.id_col} {_id_type(index)}, {score_col} double")
    n, avgdl = float(index.n_docs), float(index.avgdl) or 1.0
    # The query's term statistics: at most len(q) rows, so broadcasting is bounded by the
    # query, not by the data.
    qt = index.terms.where(F.col("term").isin(q)).select(
        "term", F.log1p((F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf")
    )
    p = index.postings.where(F.col("term").isin(q))
    tf, dl = F.col("tf").cast("double"), F.col("dl").cast("double")
    part = F.col("idf") * tf * (k1 + 1) / (tf + k1 * (1 - b + b * dl / avgdl))
    return p.join(F.broadcast(qt), "term").groupBy(index.id_col).agg(F.sum(part).alias(score_col))


def _id_type(index: TextIndex) -> str:
    return index.postings.schema[index.id_col].dataType.simpleString()


def scored_rows(df: DataFrame, index: TextIndex, query: str, id_col: str | None = None, score_col: str = "score") -> DataFrame:
    """The table's rows with their score; rows without a match are dropped.
    Statistics come from the whole indexed table; other filters are applied afterwards."""
    key = id_col or index.id_col
    scores = bm25_scores(index, query, score_col=score_col)
    if key != index.id_col:
        scores = scores.withColumnRenamed(index.id_col, key)
    return df.join(scores, on=key, how="inner")


def bm25_idf(n_docs: int, df: int) -> float:
    return math.log1p((n_docs - df + 0.5) / (df + 0.5))
