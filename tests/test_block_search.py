"""Block-max ranked search: equal to scoring everything, with fewer postings read."""

import random

import pytest
from pyspark.sql import functions as F

from snapfacet.operators import block_search as K
from snapfacet.operators import predicates as P
from snapfacet.operators import search as S
from snapfacet.operators import text_index as X

from .conftest import SF_SMALL


def corpus(spark, n=600, seed=1):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in "abcdefghij" for b in "klmnopqrst"]
    weights = [1 / (i + 1) for i in range(len(words))]
    rows = [(i, " ".join(rng.choices(words, weights, k=rng.choice([3, 8, 20, 60, 200])))) for i in range(n)]
    rows += [(n, None), (n + 1, ""), (n + 2, "ak ak"), (n + 3, "ak ak"), (None, "ak ak")]
    return spark.createDataFrame(rows, "id long, text string")


def everything(index, query, k, offset=0):
    rows = X.bm25_scores(index, query).collect()
    rows = [(r["id"], round(r["score"], 6)) for r in rows]
    return sorted(rows, key=lambda r: (-r[1], r[0] is None, r[0] or 0))[offset : offset + k]


@pytest.fixture(scope="module")
def made(spark):
    index = X.build_text_index(corpus(spark), "id", ["text"])
    return index, K.build_block_index(index, block_docs=16)


@pytest.mark.parametrize("query", ["ak", "ak bk", "jt it ht", "ak zz", "al am an ao ap"])
def test_pages_are_those_of_scoring_everything(made, query):
    index, blocks = made
    for k, offset in ((1, 0), (10, 0), (10, 25), (1000, 0)):
        got = [tuple(r) for r in blocks.top(query, k, offset).collect()]
        assert got == everything(index, query, k, offset)


def test_no_terms_no_rows(made):
    _, blocks = made
    for query in ("", "...", "zzz"):
        assert blocks.top(query, 5).collect() == []
    assert blocks.top("ak", 0).columns == ["id", "score"]


def test_bounds_hold_every_score(made):
    _, blocks = made
    by_block = {r["block"]: r["bound"] for r in blocks.bounds("ak bl").collect()}
    for block in list(by_block)[::7]:
        scores = [r["score"] for r in blocks.scores("ak bl", [block]).collect()]
        assert scores and max(scores) <= by_block[block] + 1e-9


def test_frequent_term_reads_few_postings(spark, made):
    """Not only fewer blocks are wanted: the scan of the search itself hands on fewer rows."""
    index, blocks = made
    wanted, least = blocks.wanted("ak", 10)
    all_, some = (b.agg(F.sum("postings")).first()[0] for b in (blocks.bounds("ak"), wanted))
    assert least > 0 and some < 0.35 * all_ and all_ > 400
    page = blocks.top("ak", 10)
    page.collect()
    assert _rows_scored(page) < 0.35 * all_


def _rows_scored(df):
    """Postings that the executed plan has exploded: a metric of its Generate node."""
    todo, rows = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            node = node.executedPlan()
        if "QueryStage" in node.nodeName():
            node = node.plan()
        if node.nodeName() == "Generate":
            rows += node.metrics().apply("numOutputRows").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return rows


def test_stored_index_with_stop_words_and_stems(spark, workdir):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    index = X.build_text_index(docs, "doc_id", ["text"], X.english_stop_words(), True)
    blocks = K.build_block_index(index, f"{workdir}/blocks", block_docs=32)
    again = K.BlockIndex.load(spark, f"{workdir}/blocks")
    for query in ("the ingor whons haed", "the of"):
        got = [tuple(r) for r in again.top(query, 7).collect()]
        want = sorted(((r["doc_id"], round(r["score"], 6)) for r in X.bm25_scores(index, query).collect()), key=lambda r: (-r[1], r[0]))
        assert got == want[:7]
    assert blocks.stop_words == again.stop_words and again.stemmer


def test_empty_table(spark, made):
    index = X.build_text_index(corpus(spark).where("false"), "id", ["text"])
    blocks = K.build_block_index(index)
    assert blocks.top("ak", 5).count() == 0


def test_search_by_blocks_is_the_search_by_the_index(spark, made):
    """G5 with a block index: the same page and total, with and without other filters."""
    index, blocks = made
    rows = corpus(spark).where("id IS NOT NULL").withColumn("even", F.col("id") % 2 == 0)
    for more in ({}, {"flags": {"even": (True, False)}}):
        spec = P.SearchSpec(text="ak bl", text_mode="bm25", limit=12, offset=5, **more)
        assert spec.is_open() == (not more)
        want, n = S.search(rows, spec, index=index).collect()
        got, m = S.search(rows, spec, index=blocks).collect()
        assert m == n and [r["id"] for r in got] == [r["id"] for r in sorted(want, key=lambda r: (-round(r["score"], 6), r["id"]))]


def test_blocks_are_bounded(made):
    _, blocks = made
    sizes = blocks.blocks.groupBy("term", "block").agg(F.count("*").alias("rows"), F.max("n").alias("n")).agg(F.max("rows"), F.max("n")).first()
    assert sizes[0] == 1 and sizes[1] <= 40


def test_blocks_are_written_by_as_many_tasks_as_their_postings_need(spark, made, monkeypatch):
    """Not by one task for five million documents: a task sorts ``ROWS_PER_FILE`` postings, also of one length class."""
    index, whole = made
    monkeypatch.setattr(K, "ROWS_PER_FILE", 500)
    cut = K.build_block_index(index, block_docs=16)
    held = cut.blocks.groupBy(F.col("_metadata.file_path").alias("f")).agg(F.sum("n").alias("n")).collect()
    rows = index.postings.count()
    assert sum(r["n"] for r in held) == rows and len(held) > rows / 1000
    assert max(r["n"] for r in held) < 2000
    assert sorted(map(tuple, cut.blocks.select("term", "block", "n").collect())) == sorted(map(tuple, whole.blocks.select("term", "block", "n").collect()))
    assert [tuple(r) for r in cut.top("ak bk", 10).collect()] == everything(index, "ak bk", 10)


def test_documents_are_counted_without_telling_them_apart(spark):
    """Rows of one id are rows of a block like any other: 64 of one length in blocks of 16 are four blocks and no distinct."""
    index = X.build_text_index(spark.createDataFrame([(i, "ak bk ak") for i in range(64)], "id long, text string"), "id", ["text"])
    blocks = K.build_block_index(index, block_docs=16).blocks.where("term = 'ak'").collect()
    assert len(blocks) == 4 and sum(r["n"] for r in blocks) == 64
