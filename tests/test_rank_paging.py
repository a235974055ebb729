"""Pages by rank selection: those of a full sort, with few rows kept."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from snapfacet.operators import rank_paging as R
from snapfacet.operators import search as S


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(4)
    rows = []
    for i in range(3000):
        price = rng.choice([None, 5.0, 5.0, 5.0, float(rng.randrange(200)), rng.random(), -rng.random() * 1e6, float("nan")])
        name = rng.choice([None, "", "é", "Z", "a", f"n{rng.randrange(50)}"])
        day = rng.choice([None, dt.date(2024, 1, 1) + dt.timedelta(rng.randrange(9))])
        rows.append((i, price, name, day, Decimal(rng.randrange(7)), 1))
    return spark.createDataFrame(rows, "id long, price double, name string, day date, d decimal(10,2), one int").repartition(4).cache()


@pytest.mark.parametrize("key", ["price", "name", "one"])
@pytest.mark.parametrize("descending", [True, False])
def test_pages_are_those_of_a_sort(table, key, descending, monkeypatch):
    monkeypatch.setattr(R, "WAYS", 5)
    predicate = F.col("id") % 3 > 0 if descending else None
    rows = table.where(predicate) if descending else table
    whole = [r["id"] for r in rows.orderBy(*S.order_columns(key, descending, ("id",))).collect()]
    for offset, limit in ((0, 10), (len(whole) // 2, 25), (len(whole) - 7, 25)):
        got = R.rank_page(table, predicate, key, descending, limit, offset, ("id",), most=100)
        assert [r["id"] for r in got.collect()] == whole[offset : offset + limit]


@pytest.mark.parametrize("key", ["day", "d"])
def test_other_types(table, key):
    whole = [r["id"] for r in table.orderBy(*S.order_columns(key, True, ("id",))).collect()]
    got = R.rank_page(table, None, key, True, 25, 1500, ("id",), most=100)
    assert [r["id"] for r in got.collect()] == whole[1500:1525]


def test_page_over_two_large_values(spark):
    """Both ends of the page lie in values that many rows have."""
    rows = spark.range(2000).select("id", F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("k"))
    got = R.rank_page(rows, None, "k", False, 20, 990, ("id",), most=50)
    assert [r["id"] for r in got.collect()] == [*range(1980, 2000, 2), *range(1, 20, 2)]


def test_ends(table):
    assert R.rank_page(table, None, "price", True, 25, 10**6, ("id",)).count() == 0
    assert R.rank_page(table.where("false"), None, "price", True, 25, 0, ("id",)).count() == 0
    assert R.rank_page(table, None, "price", True, 0, 0, ("id",)).count() == 0
    assert R.rank_page(table, None, "one", True, 5, 1500, (), most=10).count() == 5  # nothing to break ties by


def test_tasks_keep_few_rows(spark):
    rows = spark.range(200_000).select("id", F.xxhash64("id").alias("k"))
    page = R.rank_page(rows, None, "k", False, 25, 100_000, ("id",), most=2000)
    plan = page._jdf.queryExecution().executedPlan().toString()
    kept = max(int(x.split("(limit=")[1].split(",")[0]) for x in plan.splitlines() if "TakeOrderedAndProject(limit=" in x)
    assert kept <= 2025
    assert page.count() == 25
