import pytest

from snapfacet.llm import benchmark_decontamination as D

from . import brute
from .conftest import SF_SMALL

EXTRA = [(900, "the of"), (901, "and"), (902, ""), (903, None), (904, "Of THE of"), (904, "fox jumps"), (None, "lazy dog"), (905, "alpha " * 14)]


@pytest.mark.parametrize("window,block", [(13, 10**6), (3, 200), (1, 50)])
def test_spans_are_brute_force(spark, small, odd, window, block):
    items = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").limit(40).collect()] + EXTRA
    table = spark.createDataFrame(items, "item_id long, text string")
    for docs in (small.limit(80), odd):
        rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        want = sorted(
            (str(i), n, hit, sorted(who - {"None"})) for (i, _), (n, hit, who) in zip(rows, brute.contamination(rows, items, window))
        )
        out = D.find_benchmark(docs, table, window=window, block_words=block).select("row.doc_id", "n_words", "n_hit", "items", "n_items", "spans").collect()
        assert sorted((str(r[0]), r[1], r[2], list(r[3])) for r in out) == want
        for r in out:
            assert r["n_items"] == len(r["items"]) and sum(s["end"] - s["start"] for s in r["spans"]) == r["n_hit"]


def test_limits(spark):
    passage = " ".join(f"b{i}" for i in range(20))
    items = spark.createDataFrame([(1, passage)], "item_id long, text string")
    docs = spark.createDataFrame(
        [(1, f"x {passage} y"), (2, "clean " * 30), (3, f"{'far ' * 500}{passage}"), (4, None), (5, f"{'far ' * 380}{passage}")], "doc_id long, text string"
    )
    kept = {r[0]: r[1] for r in D.decontaminate(docs, items).select("row.doc_id", "text").collect()}
    assert set(kept) == {2, 3, 4} and kept[3].endswith("b19")  # 20 of 400 words is the limit
    cut = {r[0]: r[1] for r in D.decontaminate(docs, items, min_span=15).select("row.doc_id", "text").collect()}
    assert cut[3].split() == ["far"] * 500 and cut[4] is None


def test_empty_tables(spark, odd):
    items = spark.createDataFrame(EXTRA, "item_id long, text string")
    assert D.find_benchmark(odd.where("false"), items).count() == 0
    assert D.find_benchmark(odd, items.where("false")).selectExpr("sum(n_hit)").first()[0] == 0


def test_contract_columns(spark):
    q = D.op7_benchmark_decontamination(spark, SF_SMALL)
    assert q.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def test_long_upper_case_text_is_cut_between_words(spark):
    passages = [" ".join(f"Test{i}Passage{j}" for j in range(26)) for i in range(3)]
    text = ""
    for i, passage in enumerate(passages):  # one across each 1 MiB mark
        room = (i + 1) * 2**20 - len(passage) // 2 - len(text)
        text += "FILLING " * (room // 8) + passage.upper() + " "
    text += "MiXedCase " * 2**14
    rows = [(1, text), (2, text.lower())]
    assert len(text) > 3 * 2**20
    items = list(enumerate(passages))
    out = D.find_benchmark(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got = sorted((r[0], r[1], r[2], list(r[3])) for r in out.select("row.doc_id", "n_words", "n_hit", "items").collect())
    assert got == [(i, n, hit, sorted(who)) for (i, _), (n, hit, who) in zip(rows, brute.contamination(rows, items))]
    assert got[0][2:] == (78, ["0", "1", "2"])
