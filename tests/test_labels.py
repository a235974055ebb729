"""Display columns."""

import datetime as dt

from snapfacet.functions import labels
from snapfacet.functions.text_format import structure_text, text_items, with_structured_text
from snapfacet.operators.export import detail_view, visible_columns, with_defaults
from snapfacet.plans.transform import transform_postings
from snapfacet.schema import RAW

from .conftest import raw_posting


def _labels(spark, rows):
    df = spark.createDataFrame(rows, "lo double, hi double, f string")
    return [
        (r["s"], r["l"])
        for r in df.select(
            labels.salary_label_short("lo", "hi", "f").alias("s"), labels.salary_label_long("lo", "hi", "f").alias("l")
        ).collect()
    ]


def test_salary_labels(spark):
    got = _labels(
        spark,
        [
            (None, 10.0, "Annual"),
            (0.0, 10.0, "Annual"),
            (50000.5, 50000.5, "Hourly"),
            (50000.0, 60000.0, "Annual"),
            (2.5, None, "Daily"),
            (1234567.0, 0.0, None),
        ],
    )
    assert got == [
        ("—", "Not specified"),
        ("—", "Not specified"),
        ("$50,001/hr", "$50,001 (Hourly)"),
        ("$50,000 - $60,000/yr", "$50,000 - $60,000 (Annual)"),
        ("$3", "$3 (Daily)"),
        ("$1,234,567", "$1,234,567 (Annual)"),
    ]


def test_date_labels(spark):
    df = spark.createDataFrame([(dt.date(2025, 1, 15),), (None,)], "d date")
    got = [(r["s"], r["l"]) for r in df.select(labels.date_label_short("d").alias("s"), labels.date_label_long("d").alias("l")).collect()]
    assert got == [("Jan 15, 2025", "Wednesday, January 15, 2025"), ("—", "—")]


def test_escape_html(spark):
    df = spark.createDataFrame([("a<b> & c d",)], "t string")
    assert df.select(labels.escape_html("t").alias("h")).first()["h"] == "a&lt;b&gt; &amp; c&nbsp;d"


def test_structure_text(spark):
    texts = ["Intro.  Duties:  Do things.   More.", "1. first; or 2. second  3. third", "· a · b", "", None, "  Must:  1. x  2. y   · <z>", "a  2. b"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    want = [
        "<p>Intro.</p><h4>Duties</h4><p>Do things.</p><p>More.</p>",
        "<ol><li>first</li><li>second</li><li>third</li></ol>",
        "<ul><li>a</li><li>b</li></ul>",
        "",
        None,
        "<h4>Must</h4><ol><li>x</li><li>y</li></ol><ul><li>&lt;z&gt;</li></ul>",
        "<p>a  2. b</p>",
    ]
    assert [r["h"] for r in df.select(structure_text("t").alias("h")).collect()] == want
    assert [r["h"] for r in with_structured_text(df, "t", "h").collect()] == want


def test_text_items(spark):
    df = spark.createDataFrame([(1, "Intro.  Duties:  1. a; or 2. b   c")], "i int, t string")
    rows = sorted(tuple(r) for r in text_items(df, "i", "t").drop("section").collect())
    assert rows == [(1, 0, 0, "paragraph", "Intro."), (1, 1, 0, "numbered", "a"), (1, 1, 1, "numbered", "b"), (1, 1, 2, "paragraph", "c")]


def test_export_defaults_and_visibility(spark):
    df = spark.createDataFrame([(None, None, None, None)], "business_title string, is_full_time boolean, salary_range_from double, posted_date date")
    row = with_defaults(df).first()
    assert row["business_title"] == "" and row["is_full_time"] is False
    assert row["salary_range_from"] is None and row["posted_date"] == ""
    assert visible_columns(df).columns == ["business_title", "salary_range_from", "posted_date"]
    assert visible_columns(df, {"is_full_time": True}).columns == ["business_title", "salary_range_from", "posted_date", "is_full_time"]


def test_detail_view(spark):
    raw = spark.createDataFrame([raw_posting(), raw_posting(posting_type="Internal", title_classification="Non-Competitive")], RAW)
    rows = detail_view(transform_postings(raw)).collect()
    ext, internal = rows
    assert ext["apply_link"].endswith("?q=Data_Analyst_DEPT_OF_X")
    assert ext["title_classification"] == "Competitive-1 (Exam Required)"
    assert ext["salary"] == "$50,000 - $60,001 (Annual)"
    assert internal["apply_link"] is None and internal["internal_only"] is True
    assert internal["title_classification"] == "Non-Competitive"
