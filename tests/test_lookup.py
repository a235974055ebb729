"""Lookups by id in stored tables (F13): the right rows, from the row groups that may hold them."""

import hashlib

import pytest
from pyspark.sql import functions as F

from snapfacet.plans import pipeline
from snapfacet.sources import lookup as L

from .test_pipeline import land_snapshot, snap
from .test_trigram_index import scanned

ROWS = 20_000
SMALL_GROUPS = {"parquet.block.size": "65536", "parquet.page.size": "8192", "parquet.block.size.row.check.min": "100"}


def md5(i):
    return hashlib.md5(str(i).encode()).hexdigest()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    out = {}
    df = spark.range(ROWS).select(F.md5(F.col("id").cast("string")).alias("id"), F.col("id").alias("n"), F.lit("text").alias("text")).repartition(2)
    for name, columns in (("bloom", ["id"]), ("plain", [])):
        out[name] = str(tmp_path_factory.mktemp(name) / "t")
        L.write_for_lookup(df, out[name], columns, **SMALL_GROUPS)
    return {k: spark.read.parquet(v) for k, v in out.items()}


def test_row_groups_without_the_id_are_not_read(stored):
    for ids, most in (([md5(17)], 0.2), ([md5(i) for i in range(0, ROWS, 5000)], 0.6), ([md5("nowhere")], 0.2)):
        found = L.lookup(stored["bloom"], ids)
        want = [r["id"] for r in L.lookup(stored["plain"], ids).collect()]
        assert sorted(r["id"] for r in found.collect()) == sorted(want)
        assert scanned(found) < most * ROWS
    without = L.lookup(stored["plain"], [md5(17)])
    without.collect()
    assert scanned(without) == ROWS  # statistics alone skip nothing


def test_lists_frames_nulls_and_repeats(spark, stored):
    df = stored["bloom"]
    assert L.lookup(df, []).count() == 0 and L.lookup(df, [None]).count() == 0
    assert L.lookup(df, [md5(3), md5(3), None, "x"]).count() == 1
    many = [md5(i) for i in range(L.LISTED + 50)]
    assert L.lookup(df, many).count() == len(many)
    frame = spark.createDataFrame([(m, 1) for m in [*many, *many, None]], "id string, k int")
    assert L.lookup(df, frame).count() == len(many)
    assert L.lookup(df, [17], "n").select("id").first()[0] == md5(17)
    with pytest.raises(ValueError):
        L.write_for_lookup(df, "/nowhere", ["no"])


def test_processed_snapshots_can_be_looked_up(spark, workdir):
    land_snapshot(workdir, "2026-01-26", snap("2026-01-26", 3))
    pipeline.run_latest(spark, workdir)
    rows = spark.read.parquet(f"{workdir}/processed")
    wanted = rows.select("id", "job_id").first()
    assert [r["job_id"] for r in L.lookup(rows, [wanted["id"]]).collect()] == [wanted["job_id"]]
