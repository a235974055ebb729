"""Sources and sinks not covered by the pipeline tests: S4, S10, S12, lineage cut, facet lists."""

from pyspark.sql import functions as F

from snapfacet.operators import facets as FC
from snapfacet.plans.transform import transform_postings
from snapfacet.schema import RAW
from snapfacet.sources import snapshots as SRC

from .conftest import raw_posting


def test_raw_landing_by_key_and_listing(spark, workdir):
    a = spark.createDataFrame([raw_posting(process_date="2026-01-26T00:00:00.000")], RAW)
    b = spark.createDataFrame([raw_posting(process_date="2026-01-27T00:00:00.000")] * 2, RAW)
    SRC.write_raw(a, workdir)
    SRC.write_raw(b, workdir)
    # re-landing one key replaces only that key
    SRC.write_raw(b.limit(1), workdir)
    keys = [r[SRC.SNAPSHOT] for r in SRC.list_snapshots(spark, f"{workdir}/raw").collect()]
    assert keys == ["2026-01-26T00-00-00", "2026-01-27T00-00-00"]
    raw = SRC.read_raw_snapshot(spark, f"{workdir}/raw")
    assert raw.count() == 2
    files = SRC.list_files(spark, f"{workdir}/raw").collect()
    assert len(files) >= 2 and all(r["file"].endswith(".json") for r in files)


def test_view_and_adhoc_sql(spark):
    df = spark.createDataFrame([raw_posting(), raw_posting(agency="B")], RAW)
    jobs = SRC.register_view(transform_postings(df), "jobs_test", cache=True)
    out = SRC.adhoc_sql(spark, "SELECT agency, count(*) AS n FROM jobs_test WHERE agency <> :a GROUP BY agency", args={"a": "B"})
    assert [(r["agency"], r["n"]) for r in out.collect()] == [("DEPT OF X", 1)]
    jobs.unpersist()


def test_facet_lists_of_postings(spark):
    rows = [raw_posting(job_category="Health Legal Affairs"), raw_posting(agency="B", civil_service_title="", job_category="Green Jobs")]
    jobs = transform_postings(spark.createDataFrame(rows, RAW))
    lists = FC.facet_lists(jobs, FC.POSTINGS_FACETS)
    assert [r[0] for r in lists["agency"].collect()] == ["B", "DEPT OF X"]
    assert [r[0] for r in lists["job_categories"].collect()] == ["Green Jobs", "Health", "Legal Affairs"]
    assert [r[0] for r in lists["civil_service_title"].collect()] == ["CITY RESEARCH SCIENTIST"]


def test_snapshots_with_other_columns_are_merged_on_request(spark, workdir):
    """A snapshot written before a column was there; the union has it as null."""
    old = spark.createDataFrame([("a",)], "id string").withColumn(SRC.SNAPSHOT, F.lit("2026-01-26"))
    new = spark.createDataFrame([("b", 1)], "id string, extra int").withColumn(SRC.SNAPSHOT, F.lit("2026-01-27"))
    for df in (old, new):
        SRC.write_processed(df, workdir)
    rows = SRC.read_processed(spark, workdir, merge_schema=True).select("id", "extra", SRC.SNAPSHOT).collect()
    assert sorted(map(tuple, rows)) == [("a", None, "2026-01-26"), ("b", 1, "2026-01-27")]
