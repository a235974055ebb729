"""Ranked search by block-max postings: T2 / X5 with the blocks that cannot matter left unread.

Postings are kept in blocks: one row per (term, block of documents) with the largest contribution that any
of its documents gets from the term. A block of documents is the same for all terms, so the sum of a
block's maxima over the query terms bounds every score in it. A search

1. adds up these bounds -- it reads term, block and maximum, not the postings;
2. scores the documents of the ``k`` blocks with the highest bounds: each of them holds a document
   with a query term, so the k-th best score found there is one that the result must reach;
3. scores the documents of the blocks whose bound reaches it, and no others.

The result is that of scoring everything, ties included. Bounds are tight because a block holds documents of
about one length: blocks are cut within length classes (four to a doubling) by a hash of the id. No
sort of all documents is needed to assign them, only the number of documents per class.

Stored layout (Parquet), written by (term, block) and sorted by it, so that a search reads the row groups and
pages of its terms and blocks:

* ``blocks(term, block, n, best, postings)``: ``postings`` is an array of (id, tf, dl) with about ``block_docs`` entries at most;
* ``terms(term, df)`` and ``corpus``: as in ``text_index``, with k1 and b, which the maxima depend on.

A term that a third of all documents hold is a third of all blocks, each a row of its own: it is spread over
writer and reader tasks like any other.

Defined results: a query without known terms, or with stop words only, gives no rows; documents without tokens are
in the statistics only; a null id is a document of its own and comes last among equal scores; rows with equal ids are one document, as in ``text_index``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch
from .text_index import B, K1, ROWS_PER_FILE, TextIndex, analyze_query

BLOCK_DOCS = 1024
#: Digits that scores are rounded to, and half a unit of the last one.
DIGITS = 6
#: Longest list of blocks that goes into the scan as a filter; a longer one is joined.
LISTED = 1000
_CLASS = 1 << 32


def _part(tf: Column, dl: Column, avgdl: float, k1: float, b: float) -> Column:
    """What a posting adds to a score, but for the term's idf."""
    tf, dl = tf.cast("double"), dl.cast("double")
    return tf * (k1 + 1) / (tf + k1 * (1 - b + b * dl / (avgdl or 1.0)))


def _length_class(dl: Column) -> Column:
    return F.floor(F.log2(F.greatest(dl, F.lit(1)).cast("double")) * 4).cast("long")


@dataclass
class BlockIndex:
    blocks: DataFrame  # term, block, n, best, postings
    terms: DataFrame  # term, df
    n_docs: int
    avgdl: float
    id_col: str = "id"
    stop_words: tuple = ()
    stemmer: bool = False
    k1: float = K1
    b: float = B

    @staticmethod
    def load(spark: SparkSession, path: str) -> "BlockIndex":
        m = spark.read.parquet(f"{path}/corpus").first()
        return BlockIndex(
            spark.read.parquet(f"{path}/blocks"),
            spark.read.parquet(f"{path}/terms"),
            int(m["n_docs"]),
            float(m["avgdl"]),
            m["id_col"],
            tuple(m["stop_words"] or ()),
            bool(m["stemmer"]),
            float(m["k1"]),
            float(m["b"]),
        )

    def query_terms(self, query: str) -> list[str]:
        return analyze_query(query, self.stop_words, self.stemmer)

    def idf(self, terms: list[str]) -> DataFrame:
        """(term, idf) of the query's terms that the index has."""
        known = self.terms.where(F.col("term").isin(terms))
        return known.select("term", F.log1p((F.lit(float(self.n_docs)) - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf"))

    def bounds(self, query: str) -> DataFrame:
        """(block, bound, postings): what no score in the block exceeds, and its number of postings of the query terms."""
        terms = self.query_terms(query)
        heads = self.blocks.where(F.col("term").isin(terms)).select("term", "block", "n", "best")
        heads = heads.join(F.broadcast(self.idf(terms)), "term")  # at most one row per query term
        return heads.groupBy("block").agg(F.sum(F.col("idf") * F.col("best")).alias("bound"), F.sum("n").alias("postings"))

    def scores(self, query: str, blocks: DataFrame | list | None = None, score_col: str = "score") -> DataFrame:
        """(id, score) of the documents with a query term, in the given blocks (None: in all)."""
        terms = self.query_terms(query)
        held = self.blocks.where(F.col("term").isin(terms))
        if isinstance(blocks, list):
            held = held.where(F.col("block").isin(blocks))
        elif blocks is not None:
            held = held.join(blocks.select("block"), "block", "left_semi")
        held = held.join(F.broadcast(self.idf(terms)), "term").select("idf", F.explode("postings").alias("p"))
        part = F.col("idf") * _part(F.col("p.tf"), F.col("p.dl"), self.avgdl, self.k1, self.b)
        return held.groupBy(F.col("p.id").alias(self.id_col)).agg(F.sum(part).alias(score_col))

    def wanted(self, query: str, k: int) -> tuple[DataFrame, float]:
        """The blocks (block, bound, postings) that can hold one of the k best documents, and the score that the
        k-th of the first blocks has (0: there are fewer than k)."""
        bounds = self.bounds(query)
        first = [r["block"] for r in bounds.orderBy(F.desc("bound"), "block").limit(k).select("block").collect()]  # k numbers
        if len(first) < k:
            return bounds, 0.0
        seen = self.scores(query, first).select(F.round("score", DIGITS).alias("score"))
        reached = seen.orderBy(F.desc("score")).offset(k - 1).limit(1).first()
        least = float(reached["score"]) if reached is not None else 0.0
        return bounds.where(F.col("bound") >= F.lit(least - 10.0**-DIGITS)), least

    def top(self, query: str, k: int = 25, offset: int = 0, score_col: str = "score") -> DataFrame:
        """One page of the documents by score (rounded), then id: (id, score)."""
        empty = self.terms.sparkSession.createDataFrame([], f"{self.id_col} {self._id_type()}, {score_col} double")
        if not self.query_terms(query) or k <= 0:
            return empty
        blocks, least = self.wanted(query, k + offset)
        if least:
            some = [r["block"] for r in blocks.select("block").limit(LISTED + 1).collect()]
            blocks = some if len(some) <= LISTED else blocks
        else:
            blocks = None
        found = self.scores(query, blocks, score_col).withColumn(score_col, F.round(score_col, DIGITS))
        found = found.orderBy(F.desc(score_col), F.asc_nulls_last(self.id_col))
        return (found.offset(offset) if offset else found).limit(k)

    def _id_type(self) -> str:
        return self.blocks.schema["postings"].dataType.elementType["id"].dataType.simpleString()


def build_block_index(index: TextIndex, path: str | None = None, block_docs: int = BLOCK_DOCS, k1: float = K1, b: float = B) -> BlockIndex:
    """Block the postings of an index and store them (``path`` None: in the session's shared scratch folder)."""
    spark = index.postings.sparkSession
    path = path or scratch(spark, "blocks")
    key = F.col(index.id_col)
    posted = index.postings.select("term", key.alias("id"), "tf", "dl").withColumn("class", _length_class(F.col("dl")))
    # documents per length class: some hundred rows at most, as a length has 63 bits. The counts of a document's terms add up to
    # its length, so every document adds up to one: none has to be told from the others
    docs = F.sum(F.col("tf") / F.greatest(F.col("dl"), F.lit(1)))
    sizes = posted.groupBy("class").agg(F.round(docs).alias("docs"), F.count(F.lit(1)).alias("rows")).collect()
    parts = {r["class"]: max(1, math.ceil(r["docs"] / block_docs)) for r in sizes}
    many = F.element_at(F.create_map(*(F.lit(x).cast("long") for kv in parts.items() for x in kv)), F.col("class")) if parts else F.lit(1)
    block = F.col("class") * _CLASS + F.pmod(F.xxhash64("id"), many)
    # a block's postings meet in the task that writes it: there is one exchange, sized by the postings
    files = max(1, math.ceil(sum(r["rows"] for r in sizes) / ROWS_PER_FILE))
    grouped = posted.withColumn("block", block).repartitionByRange(files, "term", "block").groupBy("term", "block")
    best = F.max(_part(F.col("tf"), F.col("dl"), index.avgdl, k1, b))
    blocks = grouped.agg(F.count(F.lit(1)).alias("n"), best.alias("best"), F.collect_list(F.struct("id", "tf", "dl")).alias("postings"))
    blocks = blocks.sortWithinPartitions("term", "block")
    blocks.write.mode("overwrite").parquet(f"{path}/blocks")
    index.terms.orderBy("term").write.mode("overwrite").parquet(f"{path}/terms")
    row = [(index.n_docs, float(index.avgdl), index.id_col, list(index.stop_words), index.stemmer, float(k1), float(b))]
    kinds = "n_docs long, avgdl double, id_col string, stop_words array<string>, stemmer boolean, k1 double, b double"
    spark.createDataFrame(row, kinds).coalesce(1).write.mode("overwrite").parquet(f"{path}/corpus")
    return BlockIndex.load(spark, path)
