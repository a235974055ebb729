"""The index kept across snapshots: equal to one built at once, tokenising only what is new."""

import pytest
from pyspark.sql import functions as F

from snapfacet.operators import segments as G
from snapfacet.operators import text_index as X
from snapfacet.sources import versions as V

COLS = ("title", "body")
A = [("a", "Data analyst", "city data"), ("b", "Engineer", "bridges and data"), ("c", "Clerk", None), ("d", "", "")]
B = [("b", "Engineer", "bridges and data"), ("d", "", ""), ("e", "Data engineer", "pipes"), ("f", "Nurse", "health of the city"), ("f", "Nurse", "health of the city")]
C = [("a", "Data analyst", "city data"), ("e", "Data engineer", "pipes"), (None, "no id", "data data")]


def frame(spark, rows):
    return spark.createDataFrame(rows, "content_id string, title string, body string")


def at_once(spark, rows, **kw):
    rows = list(dict.fromkeys(r for r in rows if r[0] is not None))
    return X.build_text_index(frame(spark, rows), "content_id", COLS, **kw)


def same(one, two):
    assert one.n_docs == two.n_docs and one.avgdl == pytest.approx(two.avgdl)
    for a, b in ((one.postings, two.postings), (one.terms, two.terms)):
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.select(a.columns).collect()))
    for query in ("data engineer pipes", "the nurse"):
        got, want = ({r[0]: r[1] for r in X.bm25_scores(i, query).collect()} for i in (one, two))
        assert got == pytest.approx(want)


@pytest.mark.parametrize("kw", [{}, {"stop_words": ["the", "of"], "stemmer": True}])
def test_equal_to_an_index_built_at_once(spark, workdir, kw):
    index = G.SegmentedIndex(spark, f"{workdir}/idx", COLS, **kw)
    assert index.add_snapshot(frame(spark, A), "s1") == G.Change("000001-s1", 4, 0, 0)
    same(index.index(), at_once(spark, A, **kw))
    assert index.add_snapshot(frame(spark, B), "s2") == G.Change("000002-s2", 2, 0, 2)
    same(index.index(), at_once(spark, B, **kw))
    assert index.add_snapshot(frame(spark, B), "s2") == G.Change(None, 0, 0, 0)  # once more: nothing changes
    assert index.add_snapshot(frame(spark, C), "s3") == G.Change(None, 0, 1, 3)  # a is back; b, d, f are gone
    same(index.index(), at_once(spark, C, **kw))


def test_only_new_content_is_tokenised(spark, workdir, monkeypatch):
    seen = []

    def counted(df, *args):
        seen.append(sorted(r["content_id"] for r in df.select("content_id").collect()))
        return X.counted_documents(df, *args)

    monkeypatch.setattr(G, "counted_documents", counted)
    index = G.SegmentedIndex(spark, f"{workdir}/idx", COLS)
    for name, rows in (("s1", A), ("s2", B), ("s3", C)):
        index.add_snapshot(frame(spark, rows), name)
    assert seen == [["a", "b", "c", "d"], ["e", "f"], []]


def test_merge_drops_tombstones_and_keeps_scores(spark, workdir):
    index = G.SegmentedIndex(spark, f"{workdir}/idx", COLS)
    index.add_snapshot(frame(spark, A), "s1")
    index.add_snapshot(frame(spark, B), "s2")
    assert len(index.segments()) == 2
    name = index.merge()
    assert list(index.segments()) == [name] and index.segments()[name]["n"] == 4
    same(index.index(), at_once(spark, B))
    assert index.merge() is None  # nothing left to do
    assert index.add_snapshot(frame(spark, C), "s3").added == 1  # a was dropped for good, so it is read again
    same(index.index(), at_once(spark, C))
    last = sorted(index.segments())[-1]
    index.merge([last])  # some segments only: tombstones of the others stay
    same(index.index(), at_once(spark, C))


def test_empty_snapshot_and_reader_of_the_version_before(spark, workdir):
    index = G.SegmentedIndex(spark, f"{workdir}/idx", COLS)
    with pytest.raises(ValueError):
        index.index()
    index.add_snapshot(frame(spark, A), "s1")
    reader = index.index()
    index.add_snapshot(frame(spark, []), "s2")
    assert index.index().n_docs == 0 and X.bm25_scores(index.index(), "data").count() == 0
    assert X.bm25_scores(reader, "data").count() == 2  # still whole
    index.add_snapshot(frame(spark, A), "s3")
    same(index.index(), at_once(spark, A))


def test_a_job_that_dies_changes_nothing(spark, workdir, monkeypatch):
    index = G.SegmentedIndex(spark, f"{workdir}/idx", COLS)
    index.add_snapshot(frame(spark, A), "s1")
    monkeypatch.setattr(V, "publish", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        index.add_snapshot(frame(spark, B), "s2")
    monkeypatch.undo()
    same(index.index(), at_once(spark, A))
    index.add_snapshot(frame(spark, B), "s2")
    same(index.index(), at_once(spark, B))


def test_other_settings_are_an_error(spark, workdir):
    G.SegmentedIndex(spark, f"{workdir}/idx", COLS).add_snapshot(frame(spark, A), "s1")
    with pytest.raises(ValueError):
        G.SegmentedIndex(spark, f"{workdir}/idx", COLS, stemmer=True).index()


def test_query_terms_reach_the_stored_postings(spark, workdir):
    index = G.SegmentedIndex(spark, f"{workdir}/idx", COLS)
    index.add_snapshot(frame(spark, A), "s1")
    index.add_snapshot(frame(spark, B), "s2")
    plan = X.bm25_scores(index.index(), "data")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(term,data)" in plan or "In(term" in plan
    assert index.index().postings.select(F.max("dl")).first()[0] == 5


def test_pipeline_keeps_the_index(spark, workdir):
    from snapfacet.operators import predicates as P
    from snapfacet.operators import search as S
    from snapfacet.plans import pipeline
    from snapfacet.plans.transform import transform_postings
    from snapfacet.sources import snapshots as SRC

    from .conftest import raw_posting
    from .test_pipeline import land_snapshot

    jobs = lambda day, *titles: [raw_posting(job_id=t, business_title=t, process_date=f"{day}T00:00:00.000") for t in titles]
    for day, titles in (("2026-01-26", ("plumber", "nurse")), ("2026-01-27", ("nurse", "clerk")), ("2026-01-25", ("baker",))):
        land_snapshot(workdir, day, jobs(day, *titles))
        pipeline.run_latest(spark, workdir, build_index="segments")
    index = pipeline.segment_index(spark, workdir)
    assert {s: v["n"] for s, v in index.segments().items()} == {"000001-2026-01-26": 2, "000002-2026-01-27": 1}
    latest = pipeline.with_content_id(SRC.load_latest(spark, workdir))
    made = transform_postings(SRC.read_raw(spark, workdir, keys=["2026-01-27"]), with_content_id=True)
    assert sorted(r["content_id"] for r in latest.collect()) == sorted(r["content_id"] for r in made.collect())
    for term, found in (("nurses", ["nurse"]), ("plumber", []), ("clerk", ["clerk"])):
        spec = P.SearchSpec.postings(search=term, use_index=True)
        rows, total = S.search(latest, spec, index=index.index(), id_col="content_id").collect()
        assert [r["job_id"] for r in rows] == found and total == len(found)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_neither_texts_nor_postings_move_for_the_dead(spark, workdir, monkeypatch):
    """Where joins are not broadcast by size: texts of a snapshot without repeated ids are not shuffled, postings lose their
    dead documents in place, and a new segment's postings are sorted where they are made."""
    texts, stored = [], []
    monkeypatch.setattr(G, "counted_documents", lambda df, *args: (texts.append(plan(df)), X.counted_documents(df, *args))[1])
    store = G.SegmentedIndex._store
    monkeypatch.setattr(G.SegmentedIndex, "_store", lambda self, df, name: (stored.append((name, plan(df))), store(self, df, name))[1])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        index = G.SegmentedIndex(spark, f"{workdir}/idx", COLS)
        index.add_snapshot(frame(spark, A), "s1")
        index.add_snapshot(frame(spark, B), "s2")
        terms = plan(index.index().terms)
        index.merge()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in texts[0] and texts[1].count("SortMergeJoin") == 2  # ids to ids, and the new ids to their texts
    assert "SortMergeJoin" not in terms and terms.count("Exchange hashpartitioning") == 1
    postings = {name: p for name, p in stored if name.startswith(G.POSTINGS)}
    assert sum("Exchange" in p for p in postings.values()) == 1  # the merge's, by range
    assert not any("SortMergeJoin" in p for p in postings.values())
    same(index.index(), at_once(spark, B))


def test_many_documents_by_number(spark, workdir, monkeypatch):
    """Numbers of several files and rows of bits, the highest bit of a row too; bits that are broadcast, and bits that are not."""
    rows = lambda keep: [(f"{i:03d}", f"word{chr(97 + i % 26)}", f"data item{chr(97 + i % 7)}") for i in range(300) if keep(i)]
    index = G.SegmentedIndex(spark, f"{workdir}/idx", COLS)
    for n, keep in enumerate((lambda i: i < 250, lambda i: i % 3)):
        index.add_snapshot(frame(spark, rows(keep)).repartition(2, "content_id"), f"s{n}")
    want = sorted(map(tuple, at_once(spark, rows(keep)).postings.collect()))
    for most in (0, 10):
        monkeypatch.setattr(G, "BROADCAST_ROWS", most)
        assert sorted(map(tuple, index.index().postings.collect())) == want
    assert sum(r["df"] for r in index.index().terms.collect()) == len(want)
    index.merge()
    same(index.index(), at_once(spark, rows(keep)))
