"""Text index and BM25 (X1-X7) against a brute-force scorer on a fixture."""

import math
import re
from collections import Counter

import pytest

from snapfacet.functions.stemmer import stem
from snapfacet.operators import predicates as P
from snapfacet.operators import search as S
from snapfacet.operators import text_index as X

DOCS = [
    (1, "Data Analyst", "Analyse the data of the city; data quality matters.", "DEPT OF DATA", "ANALYST"),
    (2, "Engineer", "Build bridges. Café inspections and élan.", "DEPT B", "CIVIL ENGINEER"),
    (3, "Clerk", "The clerk files papers.", "DEPT A", "CLERK"),
    (4, "Nurse", "", "HEALTH", "RESEARCH SCIENTIST"),
    (5, "Runner", "Running runs ran connections connected", "DEPT R", "RUNNER"),
]
COLS = ("business_title", "job_description", "agency", "civil_service_title")


def df(spark):
    return spark.createDataFrame(DOCS, "id long, business_title string, job_description string, agency string, civil_service_title string")


def brute_force(query, stop=(), stemmer=False, k1=1.2, b=0.75):
    table = str.maketrans(X.ACCENTS_FROM, X.ACCENTS_TO)
    docs = {}
    for row in DOCS:
        text = " ".join(x for x in row[1:] if x is not None).lower().translate(table)
        toks = [t for t in re.split("[^a-z]+", text) if t and t not in stop]
        if stemmer:
            toks = [stem(t) for t in toks]
        docs[row[0]] = toks
    n = len(docs)
    avgdl = sum(len(t) for t in docs.values()) / n
    q = X.analyze_query(query, stop, stemmer)
    dfreq = Counter(t for toks in docs.values() for t in set(toks))
    out = {}
    for i, toks in docs.items():
        tf = Counter(toks)
        s = 0.0
        hit = False
        for t in q:
            if tf[t]:
                hit = True
                idf = math.log(1 + (n - dfreq[t] + 0.5) / (dfreq[t] + 0.5))
                s += idf * tf[t] * (k1 + 1) / (tf[t] + k1 * (1 - b + b * len(toks) / avgdl))
        if hit:
            out[i] = s
    return out


@pytest.mark.parametrize(
    "query,stop,stemmer",
    [
        ("data city", (), False),
        ("CAFE elan", (), False),
        ("the clerk", ("the",), False),
        ("running connection", "english", True),
    ],
)
def test_bm25_matches_brute_force(spark, query, stop, stemmer):
    if stop == "english":
        stop = tuple(X.english_stop_words())
    idx = X.build_text_index(df(spark), "id", COLS, list(stop), stemmer)
    got = {r["id"]: r["score"] for r in X.bm25_scores(idx, query).collect()}
    want = brute_force(query, stop, stemmer)
    assert set(got) == set(want)
    for k in want:
        assert got[k] == pytest.approx(want[k], rel=1e-9)


def test_only_stop_words_gives_no_rows(spark):
    idx = X.build_text_index(df(spark), "id", COLS, X.english_stop_words())
    assert X.bm25_scores(idx, "the of and").count() == 0


def test_index_covers_civil_title_but_substring_does_not(spark):
    d = df(spark)
    idx = X.build_text_index(d, "id", COLS)
    assert [r["id"] for r in X.bm25_scores(idx, "scientist").collect()] == [4]
    spec = P.SearchSpec.postings(search="scientist")
    assert S.search(d.withColumn("posted_date", d.id), spec).total.first()[0] == 0


def test_search_with_index_and_auto_fallback(spark, workdir):
    d = df(spark)
    idx = X.build_text_index(d, "id", COLS).save(f"{workdir}/idx")
    spec = P.SearchSpec(text="data", text_mode="bm25", limit=10)
    rows, total = S.search(d, spec, index=idx).collect()
    assert total == 1 and rows[0]["id"] == 1 and rows[0]["score"] > 0
    auto = P.SearchSpec(text="data", text_mode="auto", text_columns=("business_title",), order_by="id", limit=10)
    rows, total = S.search(d, auto, index=None).collect()
    assert total == 1 and "score" not in rows[0].asDict()


def test_saved_index_roundtrip(spark, workdir):
    idx = X.build_text_index(df(spark), "id", COLS, ["the"], True).save(f"{workdir}/idx2")
    again = X.TextIndex.load(spark, f"{workdir}/idx2")
    assert again.n_docs == 5 and again.stemmer is True and again.stop_words == ("the",)


def test_stemmer_examples():
    """Pairs from the published sample vocabulary of the English Snowball stemmer."""
    pairs = """
        consign consign consigned consign consigning consign consignment consign consist consist consisted consist
        consistency consist consistent consist consistently consist consists consist consolation consol consolations consol
        consolatory consolatori console consol consoled consol consoles consol consolidate consolid consolidated consolid
        consoling consol consolingly consol consols consol consonant conson conspicuous conspicu conspicuously conspicu
        conspiracy conspiraci conspirator conspir conspirators conspir conspire conspir conspired conspir conspiring conspir
        constable constabl constables constabl constance constanc constancy constanc constant constant
        knack knack knackeries knackeri knacks knack knag knag knave knave knaves knave knavish knavish kneaded knead
        kneading knead knee knee kneel kneel kneeled kneel kneeling kneel kneels kneel knees knee knell knell knelt knelt
        knew knew knick knick knif knif knife knife knight knight knightly knight knights knight knit knit knits knit
        knitted knit knitting knit knives knive knob knob knobs knob knock knock knocked knock knocker knocker
        knockers knocker knocking knock knocks knock knopp knopp knot knot knots knot
        news news dying die skies sky generally general generous generous communities communiti by by say say
        hopping hop hoping hope falling fall hissing hiss filing file agreed agre feed feed ties tie cries cri
    """.split()
    want = dict(zip(pairs[::2], pairs[1::2]))
    assert {w: stem(w) for w in want} == want


def test_term_counts_edge_cases(spark):
    rows = [(1, ""), (2, "!!! ..."), (3, "word"), (4, "b a b a b"), (5, None), (6, "  Élan élan, ÉLAN!")]
    d = spark.createDataFrame(rows, "id long, text string")
    got = {}
    for r in X.postings_frame(d, "id", ["text"]).collect():
        got.setdefault(r["id"], {})[r["term"]] = (r["tf"], r["dl"])
    assert 1 not in got and 2 not in got and 5 not in got
    assert got[3] == {"word": (1, 1)}
    assert got[4] == {"a": (2, 5), "b": (3, 5)}
    assert got[6] == {"elan": (3, 3)}


def test_postings_plan_has_no_inferred_size_filter(spark):
    d = spark.createDataFrame([(1, "b a b")], "id long, text string")
    plan = X.postings_frame(d, "id", ["text"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter (size(" not in plan


def test_stop_words_of_ones_own(spark, workdir):
    import os

    os.makedirs(f"{workdir}/words")
    with open(f"{workdir}/words/list.txt", "w", encoding="utf-8") as f:
        f.write("The\nOF and, café\n\n  THE\n")
    words = X.read_stop_words(spark, f"{workdir}/words")
    assert words == ["and", "cafe", "of", "the"]
    idx = X.build_text_index(df(spark), "id", COLS, words)
    assert X.bm25_scores(idx, "the CAFÉ of").count() == 0 and X.bm25_scores(idx, "the bridges").count() == 1
    with pytest.raises(ValueError):
        X.read_stop_words(spark, f"{workdir}/words", most=3)


@pytest.mark.parametrize("stemmer", [False, True])
def test_a_task_writes_a_bounded_number_of_postings(spark, workdir, stemmer):
    words = [f"{a}{b}" for a in "abcdefgh" for b in ("lls", "ll", "lling")]
    rows = [(i, " ".join(words[(i * 7 + j) % len(words)] for j in range(12))) for i in range(200)]
    built = X.build_text_index(spark.createDataFrame(rows, "id long, text string"), "id", ["text"], stemmer=stemmer)
    kept = built.save(f"{workdir}/idx", rows_per_file=100)
    sizes = [r["count"] for r in kept.postings.groupBy("_metadata.file_path").count().collect()]
    assert len(sizes) > 10 and max(sizes) < 400
    assert sorted(map(tuple, kept.postings.collect())) == sorted(map(tuple, built.postings.collect()))
    assert X.ROWS_PER_FILE <= 2_000_000  # what a task of four in 10 GB sorts without spilling


def test_stems_meet_in_the_task_that_writes_them(spark):
    built = X.build_text_index(df(spark), "id", COLS, stemmer=True)
    spread = X.merged_stems(built.unmerged.repartitionByRange(3, "term", "id"), "id")
    plan = spread._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("Exchange rangepartitioning")]
    assert "HashAggregate" in above and "Exchange" not in above  # the one exchange after the join is that of the write
    assert sorted(map(tuple, spread.collect())) == sorted(map(tuple, built.postings.collect()))


def test_texts_with_and_without_accents_fold_alike(spark):
    rows = [(1, "Élan CAFÉ"), (2, "elan cafe"), (3, None), (4, "日本 Žena"), (5, "")]
    got = spark.createDataFrame(rows, "id long, text string").select("id", X.normalized_text(["text"]).alias("t")).collect()
    assert {r["id"]: r["t"] for r in got} == {1: "elan cafe", 2: "elan cafe", 3: "", 4: "日本 zena", 5: ""}
