"""Substring search by trigrams: the rows of the scan, from few of the stored rows."""

import random

import pytest
from pyspark.sql import functions as F

from snapfacet.operators import predicates as P
from snapfacet.operators import trigram_index as G

ROWS = [
    (1, "Data Analyst", "Café inspections; ÉLAN and more"),
    (2, "ENGINEER", "a 100% cotton_wool \\ slash"),
    (2, "ENGINEER", "a 100% cotton_wool \\ slash"),
    (3, None, "data"),
    (4, "", ""),
    (5, "da", "ta"),
    (6, "日本語 text 😀😀😀!", "İstanbul STRASSE ß"),
    (None, "no id, but data", None),
    (7, "line\nbreak data\tbase", "x" * 5000),
    (8, "aaaa", "aXaaa"),
]
TERMS = [
    "data", "DATA ANALYST", "café", "cafe", "élan", "Élan and", "100%", "n_w", "\\ s", "da", "a", "", "zzz", "not there at all", "日本語", "😀😀", "😀😀😀", "k\nb",
    "data\tb", "i̇st", "İst", "strasse", "ß", "aaa", "aaaaa", "xxxxx", "anal%st", "an_lyst", "%", "_", "%da%ta%", "dat_ b",
]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(ROWS, "id long, title string, body string").repartition(3)


@pytest.fixture(scope="module")
def index(table):
    return G.build_trigram_index(table, ["title", "body"])


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("mode", ["literal", "compat"])
def test_rows_are_those_of_the_scan(table, index, mode):
    for term in TERMS:
        want = table.where(P.substring_any(["title", "body"], term, mode))
        assert rows(index.matching(term, mode)) == rows(want), term
    one = index.matching("data", columns=["body"])
    assert rows(one) == rows(table.where(P.substring_any(["body"], "data")))
    assert one.columns == table.columns
    with pytest.raises(ValueError):
        index.matching("data", columns=["id"])


def test_search_with_the_index(table, index):
    """G5 with a trigram index: page and total of the search by scan."""
    from snapfacet.operators import search as S

    for text, mode in (("data", "literal"), ("an_l%", "compat"), ("da", "literal"), ("CAFÉ", "auto"), ("zzz", "literal")):
        spec = P.SearchSpec(text=text, text_columns=("title", "body"), text_mode=mode, in_lists={"id": (1, 3, 5, 7)}, order_by="id")
        (got, n), (want, m) = (S.search(table, spec, substrings=s).collect() for s in (index, None))
        assert (n, got) == (m, want)


def test_short_terms_take_the_scan(index):
    assert index.candidates("da") is None and index.candidates("d_t%a", "compat") is None
    assert index.candidates("zzz").count() == 0


def test_empty_table_and_clashing_column(spark, table):
    index = G.build_trigram_index(table.where("false"), ["title"])
    assert index.matching("data").count() == 0 and index.matching("d").count() == 0
    with pytest.raises(ValueError):
        G.build_trigram_index(table.withColumn("row", F.lit(1)), ["title"])


def test_stored_index_reads_few_rows(spark, workdir):
    """A rare term: the scan of the table hands on some rows of its files, and few lists are read."""
    rng = random.Random(3)
    letters = "abcdefghij"
    texts = [(i, "".join(rng.choices(letters, k=30)) + (" needle" if i % 9000 == 17 else "")) for i in range(30_000)]
    df = spark.createDataFrame(texts, "id long, text string").repartitionByRange(2, "id")
    conf = {"parquet.block.size": 200_000, "parquet.page.size": 4096, "parquet.page.row.count.limit": 500}
    for k, v in conf.items():
        spark.conf.set(k, str(v))
    try:
        G.build_trigram_index(df, ["text"], f"{workdir}/idx")
    finally:
        for k in conf:
            spark.conf.unset(k)
    index = G.TrigramIndex.load(spark, f"{workdir}/idx")
    found = index.matching("NEEDLE")
    assert sorted(r["id"] for r in found.collect()) == [17, 9017, 18017, 27017]
    assert scanned(found) < 0.3 * 30_000
    sizes = index.lists.agg(F.max("n"), F.sum("n")).first()
    assert sizes[0] <= 1 << G.PART_BITS
    assert index.grams.agg(F.sum("n")).first()[0] == sizes[1]


def scanned(df):
    """Rows that the scans of the stored table have handed on (a metric of the executed plan)."""
    todo, total = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            node = node.executedPlan()
        if "QueryStage" in node.nodeName():
            node = node.plan()
        if node.nodeName().startswith("Scan parquet") and "text" in node.simpleString(200):
            total += node.metrics().apply("numOutputRows").value()
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return total


def brute(texts):
    """gram -> numbers of the rows (tuples of texts) that hold it."""
    held = {}
    for i, row in enumerate(texts):
        for t in row:
            for k in range(len(t or "") - 2):
                held.setdefault(t[k : k + 3], set()).add(i)
    return held


def test_lists_hold_whole_characters(spark):
    """Every trigram of every column with its rows, none of half a character."""
    texts = [("aaaa", "😀😀b😀"), (None, ""), ("ab", "c"), ("日本語日本", None), ("x\0\0\0", "aaa")]
    index = G.build_trigram_index(spark.createDataFrame(texts, "a string, b string").coalesce(1), ["a", "b"])
    assert index.lists.dtypes == [("gram", "string"), ("part", "bigint"), ("n", "int"), ("rows", "array<bigint>")]
    lists = {r["gram"]: r["rows"] for r in index.lists.collect()}
    assert lists == {g: sorted(rows) for g, rows in brute(texts).items()}
    assert {r["gram"]: r["n"] for r in index.grams.collect()} == {g: len(rows) for g, rows in lists.items()}


def test_a_task_hands_on_one_list_of_a_trigram(monkeypatch):
    import numpy as np
    import pyarrow as pa

    rng = random.Random(5)
    texts = [("".join(rng.choices("abc", k=rng.randrange(30))), rng.choice(["", None, "cab"])) for _ in range(500)]
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(500)), *(pa.array(c, pa.string()) for c in zip(*texts))], ["row", "c0", "c1"])
    for chars, apart in ((10**6, 1), (700, 30), (1, 500)):
        monkeypatch.setattr(G, "CHARS", chars)
        found, most = {}, {}
        for out in G.gram_lists([batch]):
            for r in out.to_pylist():
                found.setdefault(r["gram"], set()).update(r["rows"])
                most[r["gram"]] = most.get(r["gram"], 0) + 1
        assert found == brute(texts) and max(most.values()) <= apart


def test_very_many_characters():
    import numpy as np

    every = "".join(map(chr, [*range(1, 0xD800), *range(0xE000, 0x1E000)]))
    texts = [(every,)] + [("abc",)] * 7000
    found = {}
    for out in G._lists(np.arange(len(texts)), texts):
        for r in out.to_pylist():
            found.setdefault(r["gram"], set()).update(r["rows"])
    assert found == brute(texts)


def test_ranges():
    assert G.ranges([]) == [] and G.ranges([5]) == [(5, 5)]
    assert G.ranges([1, 2, 3, 10, 11, 50], 2) == [(1, 11), (50, 50)]
    numbers = sorted(random.Random(1).sample(range(10**6), 500))
    spans = G.ranges(numbers, 8)
    assert len(spans) == 8 and all(any(a <= n <= b for a, b in spans) for n in numbers)
