"""G1 transform and its column functions (P2-P9) on fixture rows."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from snapfacet.functions import casts
from snapfacet.functions.identity import row_hash, with_row_ids
from snapfacet.functions.phrases import split_known_phrases
from snapfacet.plans.transform import history_columns, transform_postings
from snapfacet.schema import JOB_CATEGORIES, PROCESSED, RAW

from .conftest import raw_posting


def _split(spark, texts, mode):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    return [r["p"] for r in df.select(split_known_phrases("t", JOB_CATEGORIES, mode).alias("p")).collect()]


PHRASE_CASES = [
    ("Mental Health Legal Affairs", ["Mental Health", "Legal Affairs"], ["Mental", "Health", "Legal Affairs"]),
    ("Health Mental Health", ["Health", "Mental Health"], ["Health", "Mental", "Health"]),
    (" Health", ["Health"], ["", "Health"]),
    ("Clerical Health", ["Clerical", "Health"], ["Clerical", "Health"]),
    ("Health Clerical", ["Health Clerical"], ["Health Clerical"]),
    ("", [], []),
    (None, None, None),
]


@pytest.mark.parametrize("mode", ["longest", "chained"])
def test_phrase_table(spark, mode):
    got = _split(spark, [c[0] for c in PHRASE_CASES], mode)
    want = [c[1] if mode == "longest" else c[2] for c in PHRASE_CASES]
    assert got == want


@settings(max_examples=25, deadline=None)
@given(st.lists(st.sampled_from(JOB_CATEGORIES), min_size=1, max_size=5))
def test_joined_phrases_split_back(spark, phrases):
    got = _split(spark, [" ".join(phrases)], "longest")[0]
    assert got == phrases


def test_dmy_parse_strict_and_lenient(spark):
    df = spark.createDataFrame([("15-JAN-2026",), ("5-jan-2026",), (None,)], "s string")
    got = [r["d"] for r in df.select(casts.parse_dmy("s").alias("d")).collect()]
    assert got == [dt.date(2026, 1, 15), dt.date(2026, 1, 5), None]
    bad = spark.createDataFrame([("bad",)], "s string")
    assert bad.select(casts.parse_dmy("s", lenient=True).alias("d")).first()["d"] is None
    with pytest.raises(Exception):
        bad.select(casts.parse_dmy("s").alias("d")).collect()


def test_double_cast_strict_and_lenient(spark):
    df = spark.createDataFrame([("12x",)], "s string")
    assert df.select(casts.to_double("s", lenient=True).alias("d")).first()["d"] is None
    with pytest.raises(Exception):
        df.select(casts.to_double("s").alias("d")).collect()


def test_hash_null_position_matters(spark):
    df = spark.createDataFrame([("a", None), (None, "a")], "x string, y string")
    ids = [r["h"] for r in df.select(row_hash(["x", "y"], df).alias("h")).collect()]
    assert ids[0] != ids[1]


def test_id_and_content_id_across_snapshots(spark):
    rows = [raw_posting(), raw_posting(process_date="2026-01-27T00:00:00.000")]
    raw = spark.createDataFrame(rows, RAW)
    out = transform_postings(raw, with_content_id=True).collect()
    assert out[0]["id"] != out[1]["id"]
    assert out[0]["content_id"] == out[1]["content_id"]


def test_transform_schema_and_values(spark):
    raw = spark.createDataFrame([raw_posting(), raw_posting(title_classification=None, full_time_part_time_indicator="P")], RAW)
    out = transform_postings(raw)
    assert [f.name for f in out.schema.fields] == [f.name for f in PROCESSED.fields]
    assert [f.dataType.simpleString() for f in out.schema.fields] == [f.dataType.simpleString() for f in PROCESSED.fields]
    a, b = out.collect()
    assert a["salary_range_to"] == 60000.5
    assert a["posted_date"] == dt.date(2026, 1, 20)
    assert a["posted_until_date"] == dt.date(2026, 1, 15)
    assert a["processed_date"] == dt.date(2026, 1, 26)
    assert a["requires_exam"] is True and a["is_full_time"] is True
    assert a["job_categories"] == ["Health", "Legal Affairs"]
    assert b["requires_exam"] is None and b["is_full_time"] is False
    assert len(a["id"]) == 32


def test_transform_absent_key_is_null(spark):
    rec = raw_posting()
    del rec["post_until"]
    out = transform_postings(spark.createDataFrame([rec], RAW)).first()
    assert out["posted_until_date"] is None


def test_transform_chained_mode_matches_reference(spark):
    raw = spark.createDataFrame([raw_posting(job_category="Mental Health Legal Affairs")], RAW)
    out = transform_postings(raw, phrase_mode="chained").first()
    assert out["job_categories"] == ["Mental", "Health", "Legal Affairs"]


def test_history_columns_rejects_unknown(spark):
    raw = spark.createDataFrame([raw_posting()], RAW)
    out = transform_postings(raw)
    assert "job_description" not in history_columns(out).columns
    with pytest.raises(ValueError):
        history_columns(out, exclude=("nope",))


def test_with_row_ids(spark):
    df = spark.createDataFrame([(1, "a", dt.date(2026, 1, 1)), (1, "a", dt.date(2026, 1, 2))], "k int, v string, processed_date date")
    out = with_row_ids(df).collect()
    assert out[0]["id"] != out[1]["id"] and out[0]["content_id"] == out[1]["content_id"]
    assert F is not None
