"""Keyed intake: every record once, whenever and however often it is landed, reading only new files."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from snapfacet.streaming import keyed_intake as K

SCHEMA = "id string, name string, day date"


def frame(spark, day, *ids):
    return spark.createDataFrame([(str(i), f"n{i}", dt.date(2026, 1, day)) for i in ids], SCHEMA)


def rows(df):
    return sorted((r["day"].day, r["id"]) for r in df.collect())


@pytest.fixture()
def area(spark, workdir):
    def take(df=None, append=True, **kw):
        if df is not None:
            K.land(df, f"{workdir}/landing", "day", append=append)
        schema = frame(spark, 1, 1).schema
        return K.keyed_intake(spark, f"{workdir}/landing", f"{workdir}/out", f"{workdir}/ckpt", schema, "day", **kw)

    return take, lambda: K.taken_in(spark, f"{workdir}/out")


def test_late_and_repeated_files(spark, area):
    take, out = area
    assert take(frame(spark, 5, 1, 2, 3))["read"] == 3
    assert take(frame(spark, 6, 1, 2)) == {"read": 2, "new": 2, "late": 0}
    # a late file of the older snapshot: only it is read
    assert take(frame(spark, 5, 4)) == {"read": 1, "new": 1, "late": 0}
    # landed again, with a record more
    assert take(frame(spark, 5, 1, 2, 9)) == {"read": 3, "new": 1, "late": 0}
    assert take() == {"read": 0, "new": 0, "late": 0}
    assert rows(out()) == [(5, "1"), (5, "2"), (5, "3"), (5, "4"), (5, "9"), (6, "1"), (6, "2")]


def test_in_place_of_what_was_landed(spark, area):
    """Landing a snapshot anew in other files stores no record twice."""
    take, out = area
    take(frame(spark, 5, 1, 2))
    take(frame(spark, 5, 2, 1).repartition(1), append=False)
    assert rows(out()) == [(5, "1"), (5, "2")]


def test_identity_columns_and_nulls(spark, area):
    take, out = area
    data = [("1", "a", dt.date(2026, 1, 5)), ("1", "b", dt.date(2026, 1, 5)), (None, "a", dt.date(2026, 1, 5)), ("-", "a", dt.date(2026, 1, 5)), (None, "c", dt.date(2026, 1, 5))]
    assert take(spark.createDataFrame(data, SCHEMA), identity=["id"])["new"] == 3
    assert sorted(str(r["id"]) for r in out().collect()) == ["-", "1", "None"]


def test_keys_beyond_the_watermark_are_forgotten(spark, area):
    take, out = area
    take(frame(spark, 1, 1, 2), keep="3 days")
    take(frame(spark, 20, 1), keep="3 days")
    take(frame(spark, 20, 2), keep="3 days")  # the watermark is now at the 17th
    got = take(frame(spark, 1, 3), keep="3 days")
    assert got["new"] == 0 and got["late"] == 1
    assert rows(out()) == [(1, "1"), (1, "2"), (20, "1"), (20, "2")]


def test_a_batch_run_again_replaces_itself(spark, area, workdir, monkeypatch):
    """The writer dies after its rows are stored, before the stream knows: the batch is run again."""
    take, out = area
    take(frame(spark, 5, 1))

    def dies(df):
        epoch = max(int(n) for n in os.listdir(f"{workdir}/ckpt/offsets") if n.isdigit())  # planned, not yet done
        df.withColumn(K.BATCH, F.lit(epoch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", K.BATCH).parquet(f"{workdir}/out")
        raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        take(frame(spark, 5, 2, 3), transform=dies)
    assert rows(out()) == [(5, "1"), (5, "2"), (5, "3")]
    take()
    assert rows(out()) == [(5, "1"), (5, "2"), (5, "3")]
