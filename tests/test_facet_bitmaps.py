"""Facet counts from bitmaps equal those counted over the rows."""

import random

import pytest
from pyspark.sql import functions as F

from snapfacet.operators import facet_bitmaps as B
from snapfacet.operators import facets as FC
from snapfacet.operators import search as S
from snapfacet.operators.predicates import SearchSpec

SCALAR, ARRAYS = ["kind", "size", "open"], ["tags"]


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(9)
    rows = []
    for i in range(400):
        tags = rng.choice([None, [], ["a"], ["a", "b"], ["b", "b", None], ["c", ""]])
        rows.append((i, rng.choice([None, "", "x", "y", "Z"]), rng.choice([None, 1, 2, 30]), rng.choice([None, True, False]), tags, rng.random()))
    df = spark.createDataFrame(rows, "id long, kind string, size int, open boolean, tags array<string>, price double")
    # far over one bucket of rows
    more = spark.range(90_000).select("id", F.lit("x").alias("kind"), (F.col("id") % 3).cast("int").alias("size"), (F.col("id") % 2 == 0).alias("open"))
    more = more.withColumn("tags", F.array(F.lit("a"))).withColumn("price", F.col("id") / 90_000)
    return df.repartition(3).unionByName(more)


@pytest.fixture(scope="module")
def bitmaps(table):
    return B.build_facet_bitmaps(table, SCALAR, ARRAYS)


SPECS = [
    SearchSpec(),
    SearchSpec(in_lists={"kind": ("x", "Z")}),
    SearchSpec(in_lists={"kind": ("y",), "size": (1, 30)}, any_of={"tags": ("b", "c")}),
    SearchSpec(in_lists={"kind": ("",)}, flags={"open": (True, False)}),
    SearchSpec(in_lists={"kind": ("x",)}, two_value={"size": ((30,), (30, 1))}, overlap=("price", "price", 0.2, 0.4)),
    SearchSpec(text="y", text_columns=("kind",), flags={"open": (True, True)}, any_of={"tags": ("a",)}),
    SearchSpec(in_lists={"kind": ("nowhere",)}, any_of={"tags": ("a",)}),
    SearchSpec(overlap=("price", "price", 5, None)),
]


@pytest.mark.parametrize("n", range(len(SPECS)))
def test_counts_are_those_of_the_rows(table, bitmaps, n):
    spec = SPECS[n]
    want = FC.facet_counts(table, spec, SCALAR, ARRAYS).collect()
    assert bitmaps.counts(spec).collect() == want
    assert bitmaps.total(spec).first()[0] == S.total(table, spec.predicate()).first()[0]


def test_values_need_no_rows(table, bitmaps):
    assert bitmaps.values().collect() == FC.facets(table, SCALAR, ARRAYS).collect()


def test_facet_selections_read_no_rows(bitmaps):
    """Only the bitmaps are scanned where all filters are facets; else the filtered column and the row numbers."""
    plan = bitmaps.counts(SPECS[2])._jdf.queryExecution().executedPlan().toString()
    assert "/rows" not in plan and "bits" in plan
    plan = bitmaps.counts(SPECS[4])._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<price:double,row:bigint>" in plan


def test_empty_table_and_refusals(spark, table):
    empty = B.build_facet_bitmaps(table.where("false"), SCALAR, ARRAYS)
    assert empty.counts(SPECS[2]).collect() == [] and empty.total(SPECS[2]).first()[0] == 0 and empty.total(SPECS[0]).first()[0] == 0
    with pytest.raises(ValueError):
        B.build_facet_bitmaps(table.withColumn("row", F.lit(1)), SCALAR)
    with pytest.raises(ValueError):
        empty.counts(SearchSpec(text="a", text_mode="bm25"))
