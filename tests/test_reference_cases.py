"""The reference's own unit cases (search link, date normaliser), as column tests."""

import datetime as dt

from pyspark.sql import functions as F

from snapfacet.functions import casts, labels


def test_link_title_agency(spark):
    df = spark.createDataFrame([("Data Analyst", "NYPD")], "business_title string, agency string")
    link = df.select(labels.search_link(["business_title", "agency"]).alias("l")).first()["l"]
    assert link.endswith("?q=Data_Analyst_NYPD")


def test_link_keeps_unreserved_marks(spark):
    df = spark.createDataFrame([("A (b)!", "c's ~*  d")], "t string, a string")
    link = df.select(labels.search_link(["t", "a"], base="").alias("l")).first()["l"]
    # encodeURIComponent keeps ! ~ * ' ( ) and encodes nothing else of these
    assert link == "A_(b)!_c's_~*_d"


def test_date_null_is_empty(spark):
    df = spark.createDataFrame([(None,)], "v string")
    assert df.select(casts.to_iso_date("v").alias("d")).first()["d"] == ""
    df = spark.createDataFrame([(None,)], "v long")
    assert df.select(casts.to_iso_date("v", "number").alias("d")).first()["d"] == ""


def test_date_from_milliseconds(spark):
    ms = int(dt.datetime(2025, 1, 15, tzinfo=dt.timezone.utc).timestamp() * 1000)
    df = spark.createDataFrame([(ms,)], "v long")
    assert df.select(casts.to_iso_date("v", "number").alias("d")).first()["d"] == "2025-01-15"


def test_date_from_epoch_days(spark):
    df = spark.createDataFrame([(20103,)], "v long")
    assert df.select(casts.to_iso_date("v", "number").alias("d")).first()["d"] == "2025-01-15"


def test_date_from_big_integer_ms(spark):
    ms = int(dt.datetime(2025, 1, 15, tzinfo=dt.timezone.utc).timestamp() * 1000)
    import decimal

    df = spark.createDataFrame([(decimal.Decimal(ms),)], "v decimal(20,0)")
    assert df.select(casts.to_iso_date("v", "number").alias("d")).first()["d"] == "2025-01-15"


def test_date_from_text(spark):
    df = spark.createDataFrame([("2025-01-15",), ("2025-01-15T10:30:00Z",), ("not a date",)], "v string")
    got = [r["d"] for r in df.select(casts.to_iso_date("v").alias("d")).collect()]
    assert got == ["2025-01-15", "2025-01-15", "not a date"]


def test_date_from_date_column(spark):
    df = spark.createDataFrame([(dt.date(2025, 1, 15),), (None,)], "v date")
    got = [r["d"] for r in df.select(casts.to_iso_date("v", "date").alias("d")).collect()]
    assert got == ["2025-01-15", ""]


def test_snapshot_key_from_process_date(spark):
    df = spark.createDataFrame([("2026-01-26T00:00:00.000",)], "v string")
    row = df.select(casts.snapshot_key("v").alias("k"), casts.snapshot_timestamp("v").alias("t")).first()
    assert row["k"] == "2026-01-26T00:00:00+00:00"
    assert F is not None
