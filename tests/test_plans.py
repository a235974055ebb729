"""Plan shape: pushed filters, top-k without a full sort, no Python outside the stemmer,
and a smoke run of every registered query on the smallest tables."""

import __spark_entry__ as entry
from snapfacet.plans.registry import REGISTRY

from .conftest import SF_SMALL


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_page_is_topk_with_pushed_filters(spark):
    df = entry.queries()["search_page"](spark, SF_SMALL)
    plan = plan_text(df)
    assert "TakeOrderedAndProject" in plan
    assert "PushedFilters: [IsNotNull(o_totalprice), IsNotNull(o_orderdate), In(o_orderpriority" in plan
    assert "Sort [" not in plan


def test_no_python_outside_stemmer(spark):
    # the training-data queries have tests of their own
    for name, fn in entry.queries().items():
        if name not in REGISTRY or name in ("bm25_stemmed", "intake_stream", "facet_selected_first"):
            continue
        plan = plan_text(fn(spark, SF_SMALL))
        assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan, name


def test_scan_reads_only_needed_columns(spark):
    df = entry.queries()["range_overlap"](spark, SF_SMALL)
    plan = plan_text(df)
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_extendedprice:double,l_discount:double>" in plan


def test_entry_and_all_queries_run(spark):
    assert entry.entry(spark).count() >= 0
    for name in REGISTRY:
        df = entry.queries()[name](spark, SF_SMALL)
        assert df.count() >= 0, name
    assert set(entry.oracle_sql()) <= set(entry.queries())
