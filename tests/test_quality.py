"""Quarantine: good records are processed, bad ones set aside with their reasons, both counted in the writing job."""

import pytest

from snapfacet.plans import pipeline
from snapfacet.plans import quality as Q
from snapfacet.sources import snapshots as SRC

from .conftest import raw_posting
from .test_pipeline import land_snapshot, snap


def land_mixed(root, day="2026-01-26"):
    bad = [
        raw_posting(job_id="b1", salary_range_from="a lot", process_date=f"{day}T00:00:00.000"),
        raw_posting(job_id="b2", post_until="tomorrow", posting_date="?", process_date=f"{day}T00:00:00.000"),
    ]
    nulls = raw_posting(job_id="n", salary_range_from=None, post_until=None, posting_date=..., process_date=f"{day}T00:00:00.000")
    land_snapshot(root, day, snap(day, 3) + bad + [nulls])
    with open(f"{root}/raw/{SRC.SNAPSHOT}={day}/part-0.json", "a") as f:
        f.write('{"job_id": "b3", "agency\n')


def test_bad_records_are_set_aside(spark, workdir):
    land_mixed(workdir)
    land_snapshot(workdir, "2026-01-27", snap("2026-01-27", 2))
    with pytest.raises(Exception):  # noqa: B017 - the strict run fails, as before
        pipeline.run_latest(spark, workdir)
    res = pipeline.run_latest(spark, workdir, quarantine=True)
    assert (res.message, res.snapshots, res.records, res.rejected) == ("OK", ["2026-01-26", "2026-01-27"], 6, 3)
    assert SRC.read_processed(spark, workdir).count() == 6 and SRC.read_state(spark, workdir).first()["record_count"] == 2
    aside = {r["job_id"]: r for r in Q.read_quarantine(spark, workdir).collect()}
    assert {k: r["reasons"] for k, r in aside.items()} == {"b1": ["salary_range_from"], "b2": ["posting_date", "post_until"], None: ["json"]} or {
        k: r["reasons"] for k, r in aside.items()
    } == {"b1": ["salary_range_from"], "b2": ["posting_date", "post_until"], "b3": ["json"]}
    assert aside["b1"]["salary_range_from"] == "a lot" and {r["snapshot"] for r in aside.values()} == {"2026-01-26"}
    assert any('"b3"' in (r[SRC.CORRUPT_COL] or "") for r in aside.values())
    assert pipeline.run_latest(spark, workdir, quarantine=True).message == "No new data"


def test_a_snapshot_of_bad_records_only(spark, workdir):
    land_snapshot(workdir, "2026-01-26", [raw_posting(salary_range_to="x")])
    res = pipeline.run_latest(spark, workdir, quarantine=True)
    assert (res.message, res.records, res.rejected) == ("No good records", 0, 1)
    assert SRC.read_state(spark, workdir).first()["snapshot"] is None
    land_snapshot(workdir, "2026-01-26", snap("2026-01-26", 2))  # landed anew
    assert pipeline.run_latest(spark, workdir, quarantine=True).records == 2


def jobs(spark, group, run):
    spark.sparkContext.setJobGroup(group, group)
    run()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_counting_takes_no_job(spark, workdir):
    """Observed counts: the write is the only job; counting what was written takes one more."""
    land_snapshot(workdir, "2026-01-26", snap("2026-01-26", 5))
    raw = SRC.read_raw(spark, workdir, keep_corrupt=True)
    one = jobs(spark, "plain write", lambda: raw.drop(SRC.CORRUPT_COL).write.parquet(f"{workdir}/plain"))
    counted = Q.Counted(raw, ["2026-01-26"])
    assert jobs(spark, "counted write", lambda: counted.good.write.parquet(f"{workdir}/counted")) == one
    assert counted.counts() == {"2026-01-26": (5, 0)}
    plain, strict = f"{workdir}/a", f"{workdir}/b"
    for root in (plain, strict):
        land_snapshot(root, "2026-01-26", snap("2026-01-26", 5))
    with_ = jobs(spark, "quarantine run", lambda: pipeline.run_latest(spark, plain, quarantine=True))
    assert with_ < jobs(spark, "strict run", lambda: pipeline.run_latest(spark, strict))
    with pytest.raises(ValueError):
        Q.Counted(raw, [str(i) for i in range(Q.MOST + 1)])
