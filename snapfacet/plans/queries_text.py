"""Registered queries: text index and scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.identity import row_hash
from ..operators import block_search as K
from ..operators import facets as FC
from ..operators import predicates as P
from ..operators import search as S
from ..operators import text_index as X
from ..operators.segments import SegmentedIndex
from ..session import scratch, table
from .registry import register

INDEX_COLUMNS = ("text", "source")
QUERY = "Haed ingor WHON"

# Oracle side of tokenising: lower, strip accents, split at non-letters, drop empties.
_TOKENS_SQL = """
    d AS (SELECT doc_id, lang,
                 list_filter(string_split_regex(strip_accents(lower(concat_ws(' ', text, source))), '[^a-z]+'),
                             lambda x: x <> '') AS toks
          FROM documents),
    t AS (SELECT doc_id, len(toks) AS dl, unnest(toks) AS term FROM d),
    post AS (SELECT term, doc_id, count(*) AS tf, dl FROM t GROUP BY term, doc_id, dl),
    corpus AS (SELECT count(*) AS n, avg(len(toks)) AS avgdl FROM d),
    dfs AS (SELECT term, count(*) AS df FROM post GROUP BY term)
"""

def _scores_sql(*terms):
    return (
        "WITH "
        + _TOKENS_SQL
        + f""",
    q AS (SELECT unnest({list(terms)}) AS term),
    scores AS (
      SELECT p.doc_id,
             sum(ln(1 + (c.n - f.df + 0.5) / (f.df + 0.5)) * p.tf * (1.2 + 1)
                 / (p.tf + 1.2 * (1 - 0.75 + 0.75 * p.dl / c.avgdl))) AS score
      FROM post p JOIN q ON p.term = q.term JOIN dfs f ON f.term = p.term, corpus c
      GROUP BY p.doc_id)
"""
    )


_SCORES_SQL = _scores_sql("haed", "ingor", "whon")
_PAGE_SQL = " SELECT doc_id, round(score, 6) AS score FROM scores ORDER BY round(score, 6) DESC, doc_id LIMIT 25"


def _documents(spark, sf_dir):
    return table(spark, sf_dir, "documents")


_STORED: dict = {}


def _listing(spark, path):
    """Files of a table with their sizes and times, from the file system that holds it (no file is
    opened): the table as it is now."""
    files = spark.read.format("binaryFile").load(path).select("path", "length", "modificationTime")
    return tuple(sorted(tuple(map(str, r)) for r in files.collect()))


def _index(spark, sf_dir, stop_words=None, stemmer=False):
    """The stored index of ``documents``: built once per application and state of the table, and
    read for every search, as a page that keeps its index does. ``index_build`` measures the
    building."""
    source = f"{sf_dir.rstrip('/')}/documents.parquet"
    key = (spark.sparkContext.applicationId, _listing(spark, source), tuple(stop_words or ()), stemmer)
    if key not in _STORED:
        built = X.build_text_index(_documents(spark, sf_dir), "doc_id", INDEX_COLUMNS, stop_words, stemmer)
        _STORED[key] = built.save(scratch(spark, "index"))
    return _STORED[key]


@register("index_build", "WITH " + _TOKENS_SQL + " SELECT term, df FROM dfs")
def index_build(spark, sf_dir):
    """The whole build with its writes; returns the stored terms."""
    built = X.build_text_index(_documents(spark, sf_dir), "doc_id", INDEX_COLUMNS)
    return built.save(scratch(spark, "index")).terms.select("term", "df")


@register("index_postings", "WITH " + _TOKENS_SQL + " SELECT term, doc_id, tf, dl FROM post")
def index_postings(spark, sf_dir):
    return X.postings_frame(_documents(spark, sf_dir), "doc_id", INDEX_COLUMNS)


@register(
    "index_stats",
    "WITH "
    + _TOKENS_SQL
    + """
    SELECT f.term, f.df, round(ln(1 + (c.n - f.df + 0.5) / (f.df + 0.5)), 9) AS idf, c.n AS n_docs, round(c.avgdl, 6) AS avgdl
    FROM dfs f, corpus c
    """,
)
def index_stats(spark, sf_dir):
    idx = X.build_text_index(_documents(spark, sf_dir), "doc_id", INDEX_COLUMNS)
    n = float(idx.n_docs)
    return idx.terms.select(
        "term",
        "df",
        F.round(F.log1p((F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5)), 9).alias("idf"),
        F.lit(idx.n_docs).cast("long").alias("n_docs"),
        F.round(F.lit(idx.avgdl), 6).alias("avgdl"),
    )


@register(
    "bm25_top",
    _SCORES_SQL
    + """
    SELECT doc_id, round(score, 6) AS score FROM scores
    ORDER BY round(score, 6) DESC, doc_id LIMIT 25
    """,
)
def bm25_top(spark, sf_dir):
    scores = X.bm25_scores(_index(spark, sf_dir), QUERY).select("doc_id", F.round("score", 6).alias("score"))
    return S.page(scores, None, "score", True, 25, 0, ("doc_id",))


@register(
    "bm25_filtered",
    _SCORES_SQL
    + """
    SELECT s.doc_id, d.lang, d.n_chars, round(s.score, 6) AS score
    FROM scores s JOIN documents d ON d.doc_id = s.doc_id
    WHERE d.lang IN ('en', 'de') AND d.n_chars >= 300
    """,
)
def bm25_filtered(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    rows = X.scored_rows(docs, _index(spark, sf_dir), QUERY)
    spec = P.SearchSpec(in_lists={"lang": ("en", "de")}, overlap=("n_chars", "n_chars", 300, None))
    return rows.where(spec.predicate()).select("doc_id", "lang", "n_chars", F.round("score", 6).alias("score"))


_BLOCKS: dict = {}


def _blocks(spark, sf_dir):
    """The block-max index beside the stored one, kept like it."""
    index = _index(spark, sf_dir)
    if id(index) not in _BLOCKS:
        _BLOCKS[id(index)] = (index, K.build_block_index(index))
    return _BLOCKS[id(index)][1]


@register("bm25_top_blocks", _SCORES_SQL + _PAGE_SQL)
def bm25_top_blocks(spark, sf_dir):
    """The page of ``bm25_top`` from the blocks that can hold one of its documents."""
    return _blocks(spark, sf_dir).top(QUERY, 25)


@register("bm25_common_blocks", _scores_sql("the", "in") + _PAGE_SQL)
def bm25_common_blocks(spark, sf_dir):
    """T2 for terms that many documents hold: most blocks are passed over."""
    return _blocks(spark, sf_dir).top("the IN", 25)


def _two_snapshots(spark, sf_dir):
    """The index kept over two snapshots of all documents: in the first the English texts were others."""
    docs = _documents(spark, sf_dir).select("doc_id", *INDEX_COLUMNS, "lang")
    before = docs.withColumn("text", F.when(F.col("lang") == "en", F.concat(F.lit("draft "), "text")).otherwise(F.col("text")))
    index = SegmentedIndex(spark, scratch(spark, "segments"), INDEX_COLUMNS)
    for name, rows in (("first", before), ("second", docs)):
        index.add_snapshot(rows.withColumn("content_id", row_hash(["doc_id", *INDEX_COLUMNS], rows)), name)
    return index, docs


@register("index_after_two_snapshots", "WITH " + _TOKENS_SQL + " SELECT term, df FROM dfs")
def index_after_two_snapshots(spark, sf_dir):
    """After the second snapshot the index is that of its contents; only the English texts, which are
    new in it, were tokenised for it."""
    return _two_snapshots(spark, sf_dir)[0].index().terms.select("term", "df")


@register("bm25_after_merge", _SCORES_SQL + _PAGE_SQL)
def bm25_after_merge(spark, sf_dir):
    """X5 over the merged segments: the page of ``bm25_top``."""
    index, docs = _two_snapshots(spark, sf_dir)
    index.merge()
    rows = docs.withColumn("content_id", row_hash(["doc_id", *INDEX_COLUMNS], docs))
    scores = X.scored_rows(rows.select("doc_id", "content_id"), index.index(), QUERY).select("doc_id", F.round("score", 6).alias("score"))
    return S.page(scores, None, "score", True, 25, 0, ("doc_id",))


@register("bm25_stemmed", None)
def bm25_stemmed(spark, sf_dir):
    """Stop words and the English Snowball stemmer on: no SQL oracle (the stemmer has no SQL form);
    the unit tests check it against a brute-force scorer on a fixture."""
    idx = _index(spark, sf_dir, stop_words=X.english_stop_words(), stemmer=True)
    scores = X.bm25_scores(idx, "the ingoring whons haed").select("doc_id", F.round("score", 6).alias("score"))
    return S.page(scores, None, "score", True, 25, 0, ("doc_id",))


_FILTERED_SQL = """
    , hits AS (SELECT s.doc_id, s.score, d.lang, d.source, d.n_chars FROM scores s JOIN documents d ON d.doc_id = s.doc_id)
"""


@register(
    "facet_counts_bm25",
    _SCORES_SQL
    + _FILTERED_SQL
    + """
    SELECT 'lang' AS facet, lang AS value, count(*) AS n FROM hits WHERE source IN ('src0', 'src1', 'src2') AND n_chars >= 300 AND lang <> '' GROUP BY 2
    UNION ALL
    SELECT 'source', source, count(*) FROM hits WHERE lang IN ('en', 'de') AND n_chars >= 300 AND source <> '' GROUP BY 2
    """,
)
def facet_counts_bm25(spark, sf_dir):
    """E1 under a text search by the index."""
    lists = {"lang": ("en", "de"), "source": ("src0", "src1", "src2")}
    spec = P.SearchSpec(text=QUERY, text_mode="bm25", in_lists=lists, overlap=("n_chars", "n_chars", 300, None))
    return FC.facet_counts(_documents(spark, sf_dir), spec, scalar=["lang", "source"], index=_index(spark, sf_dir), id_col="doc_id")


@register(
    "search_auto_indexed",
    _SCORES_SQL + _FILTERED_SQL + "SELECT doc_id, lang, round(score, 6) AS score FROM hits WHERE lang IN ('en', 'de') ORDER BY hits.score DESC, doc_id LIMIT 25",
)
def search_auto_indexed(spark, sf_dir):
    """With an index, the mode ``auto`` is the search by score."""
    docs = _documents(spark, sf_dir).select("doc_id", "lang", "text", "source")
    spec = P.SearchSpec(text=QUERY, text_columns=INDEX_COLUMNS, text_mode="auto", in_lists={"lang": ("en", "de")}, order_by="lang")
    page = S.search(docs, spec, index=_index(spark, sf_dir), id_col="doc_id").page
    return page.select("doc_id", "lang", F.round("score", 6).alias("score"))


@register(
    "search_auto",
    """
    SELECT doc_id, lang, n_chars FROM documents
    WHERE contains(lower(text), 'whon') OR contains(lower(source), 'whon')
    ORDER BY n_chars DESC NULLS LAST, doc_id LIMIT 25
    """,
)
def search_auto(spark, sf_dir):
    docs = _documents(spark, sf_dir).select("doc_id", "lang", "n_chars", "text", "source")
    spec = P.SearchSpec(text="whon", text_columns=INDEX_COLUMNS, text_mode="auto", order_by="n_chars", tiebreak="doc_id")
    return S.search(docs, spec, index=None).page.select("doc_id", "lang", "n_chars")
