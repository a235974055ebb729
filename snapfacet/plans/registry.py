"""Registered queries: the operators of the library run on the driver tables.

Each entry is ``name -> (builder(spark, sf_dir) -> DataFrame, oracle SQL or None)``.
The driver tables hold no postings, so each operator runs on columns of the same shape.
Every query reads whole tables; limits appear only where paging is the feature.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import predicates as P
from ..operators import rank_paging as R
from ..operators import search as S
from ..session import table

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        REGISTRY[name] = (fn, sql)
        return fn

    return deco


# ---------------------------------------------------------------------------
# Search: page, total, paging
# ---------------------------------------------------------------------------

ORDERS_SPEC = P.SearchSpec(
    in_lists={"o_orderpriority": ("1-URGENT", "2-HIGH", "5-LOW")},
    overlap=("o_totalprice", "o_totalprice", 100000.0, 300000.0),
    dates=("o_orderdate", "1996-01-01", "1999-12-31"),
    order_by="o_totalprice",
    descending=True,
    limit=25,
    offset=50,
    tiebreak="o_orderkey",
)

_ORDERS_WHERE = """
    o_orderpriority IN ('1-URGENT', '2-HIGH', '5-LOW')
    AND o_totalprice >= 100000.0 AND o_totalprice <= 300000.0
    AND o_orderdate >= DATE '1996-01-01' AND o_orderdate <= DATE '1999-12-31'
"""


@register(
    "search_page",
    f"""
    SELECT * FROM orders WHERE {_ORDERS_WHERE}
    ORDER BY o_totalprice DESC NULLS LAST, o_orderkey ASC NULLS LAST
    LIMIT 25 OFFSET 50
    """,
)
def search_page(spark, sf_dir):
    return S.search(table(spark, sf_dir, "orders"), ORDERS_SPEC).page


@register("search_total", f"SELECT count(*) AS total FROM orders WHERE {_ORDERS_WHERE}")
def search_total(spark, sf_dir):
    return S.search(table(spark, sf_dir, "orders"), ORDERS_SPEC).total


@register(
    "page_count",
    f"SELECT count(*) AS total, CAST(ceil(count(*) / 25.0) AS BIGINT) AS pages FROM orders WHERE {_ORDERS_WHERE}",
)
def page_count(spark, sf_dir):
    return S.page_count(S.search(table(spark, sf_dir, "orders"), ORDERS_SPEC).total, 25)


@register(
    "keyset_page",
    f"""
    SELECT * FROM orders WHERE {_ORDERS_WHERE}
      AND (o_totalprice < 250000.0 OR (o_totalprice = 250000.0 AND o_orderkey > 100) OR o_totalprice IS NULL)
    ORDER BY o_totalprice DESC NULLS LAST, o_orderkey ASC NULLS LAST
    LIMIT 25
    """,
)
def keyset_page(spark, sf_dir):
    return S.keyset_page(
        table(spark, sf_dir, "orders"),
        ORDERS_SPEC.predicate(),
        key="o_totalprice",
        unique="o_orderkey",
        after_key=250000.0,
        after_unique=100,
        descending=True,
        limit=25,
    )


@register(
    "last_page",
    f"""
    WITH f AS (
      SELECT *, row_number() OVER (ORDER BY o_totalprice DESC NULLS LAST, o_orderkey ASC NULLS LAST) AS rn,
             count(*) OVER () AS n
      FROM orders WHERE {_ORDERS_WHERE})
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
    FROM f WHERE rn > (CAST(ceil(n / 25.0) AS BIGINT) - 1) * 25
    """,
)
def last_page(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    pred = ORDERS_SPEC.predicate()
    n = S.total(orders, pred).first()[0]
    return S.last_page(orders, pred, "o_totalprice", True, 25, n, ("o_orderkey",))


@register(
    "deep_page",
    """
    WITH r AS (
      SELECT *, row_number() OVER (ORDER BY l_extendedprice DESC NULLS LAST, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS rn,
             count(*) OVER () AS n FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_extendedprice FROM r WHERE rn > n // 2 AND rn <= n // 2 + 25
    """,
)
def deep_page(spark, sf_dir):
    """T4: the page in the middle of all line items, found by rank selection."""
    lines = table(spark, sf_dir, "lineitem")
    middle = lines.count() // 2
    ties = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    found = R.rank_page(lines, None, "l_extendedprice", True, 25, middle, ties, most=2000)
    return found.select("l_orderkey", "l_linenumber", "l_extendedprice")


@register(
    "search_sort_asc_nulls",
    """
    WITH o AS (
      SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority,
             CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS o_totalprice
      FROM orders)
    SELECT * FROM o WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
    ORDER BY o_totalprice ASC NULLS LAST, o_orderkey ASC NULLS LAST
    LIMIT 25 OFFSET 3950
    """,
)
def search_sort_asc_nulls(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "o_orderpriority",
        F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
    )
    spec = P.SearchSpec(
        in_lists={"o_orderpriority": ("1-URGENT", "2-HIGH")},
        order_by="o_totalprice",
        descending=False,
        limit=25,
        offset=3950,
        tiebreak="o_orderkey",
    )
    return S.search(o, spec).page


# The query families register themselves on import.
from . import queries_columns, queries_filters, queries_history, queries_pipeline, queries_postings, queries_text, queries_transform  # noqa: E402,F401
