"""Predicates, paging, totals and facets."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from snapfacet.operators import facets as FC
from snapfacet.operators import predicates as P
from snapfacet.operators import search as S

ROWS = [
    # id, title, agency, salary_from, salary_to, posted, full_time, exam, posting_type, cats
    ("a", "Data Analyst", "DEPT A", 50.0, 60.0, dt.date(2026, 1, 20), True, True, "External", ["Health"]),
    ("b", "axb Engineer", "DEPT B", 40.0, 45.0, dt.date(2026, 1, 10), False, None, "Internal", ["Legal Affairs"]),
    ("c", "Clerk", "DEPT A", None, None, None, None, False, "External", None),
    ("d", "Data_Scientist", "DEPT C", 70.0, None, dt.date(2026, 1, 25), True, False, "External", ["Health", "Green Jobs"]),
    ("e", "Manager", "DEPT B", 60.0, 90.0, dt.date(2026, 1, 20), True, True, "Internal", []),
]
SCHEMA = (
    "id string, business_title string, agency string, salary_range_from double, salary_range_to double, "
    "posted_date date, is_full_time boolean, requires_exam boolean, posting_type string, job_categories array<string>"
)


def jobs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).withColumn("job_description", F.lit(""))


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_tri_state_both_and_none_keep_nulls(spark):
    df = jobs(spark)
    assert P.tri_state("is_full_time", True, True) is None
    assert P.tri_state("is_full_time", False, False) is None
    assert ids(df.where(P.tri_state("is_full_time", True, False))) == ["a", "d", "e"]
    assert ids(df.where(P.tri_state("is_full_time", False, True))) == ["b"]


def test_range_overlap_inclusive_and_null(spark):
    df = jobs(spark)
    # job 50-60 vs min 60 / max 50: overlap at the edges
    assert "a" in ids(df.where(P.range_overlap("salary_range_from", "salary_range_to", 60.0, 50.0)))
    # upper bound null with a minimum given: no match
    assert "d" not in ids(df.where(P.range_overlap("salary_range_from", "salary_range_to", 65.0, None)))


def test_last_n_days_boundary(spark):
    df = jobs(spark)
    got = ids(df.where(P.last_n_days("posted_date", "5", as_of="2026-01-25")))
    assert got == ["a", "d", "e"]
    assert P.last_n_days("posted_date", "custom") is None


def test_wildcard_literal_vs_compat(spark):
    df = jobs(spark)
    assert ids(df.where(P.substring_any(["business_title"], "a_b", "literal"))) == []
    assert ids(df.where(P.substring_any(["business_title"], "a_b", "compat"))) == ["b"]
    assert ids(df.where(P.substring_any(["business_title"], "DATA_", "literal"))) == ["d"]


def test_contains_any_and_facets(spark):
    df = jobs(spark)
    assert ids(df.where(P.contains_any("job_categories", ["Green Jobs", "Legal Affairs"]))) == ["b", "d"]
    cats = [r["value"] for r in FC.facet_array_values(df, "job_categories").collect()]
    assert cats == ["Green Jobs", "Health", "Legal Affairs"]
    ag = [r["agency"] for r in FC.facet_values(df, "agency").collect()]
    assert ag == ["DEPT A", "DEPT B", "DEPT C"]


def test_ui_default_external_only(spark):
    spec = P.SearchSpec.ui_default()
    res = S.search(jobs(spark), spec)
    rows, total = res.collect()
    assert total == 3
    # newest first, nulls last, id breaks ties
    assert [r["id"] for r in rows] == ["d", "a", "c"]


def test_postings_spec_all_filters(spark):
    spec = P.SearchSpec.postings(
        search="data",
        agencies=["DEPT A", "DEPT C"],
        categories=["Health"],
        full_time=["full_time"],
        exam=["requires_exam", "no_exam"],
        posting_types=["External", "Internal"],
        salary_min=55,
        posted_preset="custom",
        posted_from="2026-01-01",
        posted_to="2026-01-31",
    )
    rows, total = S.search(jobs(spark), spec).collect()
    # d matches everything but has no upper salary bound: a minimum excludes it
    assert total == 1 and [r["id"] for r in rows] == ["a"]


def test_sort_key_allow_list():
    assert P.validate_sort_key("agency") == "agency"
    assert P.validate_sort_key("id; drop table") == "posted_date"


def test_null_sorts_last_ascending(spark):
    df = jobs(spark)
    rows = S.page(df, None, "salary_range_from", descending=False, limit=10, tiebreak=("id",)).collect()
    assert [r["id"] for r in rows][-1] == "c"


@settings(max_examples=10, deadline=None)
@given(st.integers(min_value=1, max_value=4))
def test_pages_concatenate_to_full_order(spark, size):
    df = jobs(spark)
    full = [r["id"] for r in S.page(df, None, "posted_date", True, 100, 0, ("id",)).collect()]
    pages = []
    for off in range(0, len(full), size):
        pages += [r["id"] for r in S.page(df, None, "posted_date", True, size, off, ("id",)).collect()]
    assert pages == full


def test_keyset_equals_offset_paging(spark):
    df = jobs(spark)
    full = S.page(df, None, "posted_date", True, 100, 0, ("id",)).collect()
    seen = []
    last = None
    while True:
        if last is None:
            chunk = S.page(df, None, "posted_date", True, 2, 0, ("id",)).collect()
        else:
            chunk = S.keyset_page(df, None, "posted_date", "id", last["posted_date"], last["id"], True, 2).collect()
        if not chunk:
            break
        seen += chunk
        last = chunk[-1]
    assert [r["id"] for r in seen] == [r["id"] for r in full]


def test_total_and_page_count(spark):
    res = S.search(jobs(spark), P.SearchSpec(order_by="posted_date", limit=2))
    pc = S.page_count(res.total, 2).first()
    assert pc["total"] == 5 and pc["pages"] == 3


def test_facets_one_scan_and_counts(spark):
    df = jobs(spark)
    pairs = [(r["facet"], r["value"]) for r in FC.facets(df, ["agency"], ["job_categories"]).collect()]
    assert ("agency", "DEPT C") in pairs and ("job_categories", "Green Jobs") in pairs
    spec = P.SearchSpec(in_lists={"agency": ("DEPT A",)}, any_of={"job_categories": ("Health",)})
    counts = {(r["facet"], r["value"]): r["n"] for r in FC.facet_counts(df, spec, ["agency"], ["job_categories"]).collect()}
    # agency counts ignore the agency filter but keep the category filter
    assert counts[("agency", "DEPT A")] == 1 and counts[("agency", "DEPT C")] == 1
    # category counts ignore the category filter but keep the agency filter
    assert counts[("job_categories", "Health")] == 1 and ("job_categories", "Legal Affairs") not in counts


def test_selected_first_and_search(spark):
    values = spark.createDataFrame([("beta",), ("Alpha",), ("gamma",), ("delta",)], "value string")
    got = [(r["value"], r["position"]) for r in FC.selected_first(values, ["gamma"]).collect()]
    assert got == [("gamma", 1), ("Alpha", 2), ("beta", 3), ("delta", 4)]
    assert [r["value"] for r in FC.facet_search(values, "ALP").collect()] == ["Alpha"]


def test_last_page_equals_offset_paging(spark):
    df = jobs(spark)
    for desc in (True, False):
        for size in (2, 3, 5):
            full = [r["id"] for r in S.page(df, None, "posted_date", desc, 100, 0, ("id",)).collect()]
            start = (len(full) - 1) // size * size
            got = [r["id"] for r in S.last_page(df, None, "posted_date", desc, size, len(full), ("id",)).collect()]
            assert got == full[start:], (desc, size)


@settings(max_examples=8, deadline=None)
@given(st.integers(min_value=1, max_value=6), st.sampled_from(["External", "Internal", None]))
def test_total_equals_sum_of_page_sizes(spark, size, kind):
    df = jobs(spark)
    spec = P.SearchSpec(two_value={"posting_type": (((kind,) if kind else ()), P.POSTING_TYPES)}, order_by="posted_date", limit=size, tiebreak="id")
    total_rows = S.search(df, spec).total.first()[0]
    seen = 0
    for p in range(SearchPages(total_rows, size)):
        seen += S.search(df, spec.with_(offset=p * size)).page.count()
    assert seen == total_rows


def SearchPages(n, size):
    return S.SearchResult.pages(n, size)


def test_null_flag_passes_only_without_filter(spark):
    df = jobs(spark)  # row "b" has requires_exam = null
    none = P.SearchSpec.postings(exam=[])
    both = P.SearchSpec.postings(exam=["requires_exam", "no_exam"])
    only = P.SearchSpec.postings(exam=["no_exam"])
    assert "b" in ids(df.where(none.predicate())) and "b" in ids(df.where(both.predicate()))
    assert "b" not in ids(df.where(only.predicate()))
    assert ids(df.where(only.predicate())) == ["c", "d"]


def test_one_of_two_with_an_unknown_value(spark):
    df = jobs(spark)
    assert P.one_of_two("posting_type", ["Other"], P.POSTING_TYPES) is not None
    assert df.where(P.one_of_two("posting_type", ["Other"], P.POSTING_TYPES)).count() == 0
    assert P.one_of_two("posting_type", [], P.POSTING_TYPES) is None and P.one_of_two("posting_type", P.POSTING_TYPES, P.POSTING_TYPES) is None


def test_facet_counts_count_the_text_search(spark):
    from snapfacet.operators import facets as FC
    from snapfacet.operators import text_index as X

    rows = [("1", "cat food", "A", 1.0), ("2", "dog food", "A", 2.0), ("3", "cat toy", "B", 3.0)]
    df = spark.createDataFrame(rows, "id string, business_title string, agency string, salary_range_to double")
    index = X.build_text_index(df, "id", ("business_title",))
    base = P.SearchSpec(text="cat", text_columns=("business_title",), order_by="id")
    for mode in ("bm25", "auto", "literal"):
        got = {r["value"]: r["n"] for r in FC.facet_counts(df, base.with_(text_mode=mode), scalar=["agency"], index=index).collect()}
        assert got == {"A": 1, "B": 1}, mode
    got = {r["value"]: r["n"] for r in FC.facet_counts(df, base.with_(text_mode="auto"), scalar=["agency"]).collect()}
    assert got == {"A": 1, "B": 1}


def test_facet_counts_push_the_common_filters(spark, workdir):
    from snapfacet.operators import facets as FC

    df = spark.createDataFrame([("1", "A", 5.0)], "id string, agency string, price double")
    df.write.parquet(f"{workdir}/t")
    spec = P.SearchSpec(in_lists={"agency": ("A",)}, overlap=("price", "price", 1.0, 9.0), order_by="id")
    plan = FC.facet_counts(spark.read.parquet(f"{workdir}/t"), spec, scalar=["agency"])._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(price,1.0)" in plan
