"""Snapshot pipeline (S1-S12, J1, W1, G2-G4, R1) on fixture JSON."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from snapfacet.operators import history as H
from snapfacet.plans import pipeline
from snapfacet.schema import RAW
from snapfacet.sources import snapshots as SRC
from snapfacet.streaming import intake as R

from .conftest import SF_SMALL, raw_posting, write_json_lines


def land_snapshot(root, day, records):
    """Land raw records as JSON lines under the snapshot key folder."""
    write_json_lines(f"{root}/raw/{SRC.SNAPSHOT}={day}/part-0.json", records)


def snap(day, n, **kw):
    return [raw_posting(job_id=str(700000 + i), process_date=f"{day}T00:00:00.000", **kw) for i in range(n)]


def test_run_latest_is_idempotent(spark, workdir):
    land_snapshot(workdir, "2026-01-26", snap("2026-01-26", 3))
    first = pipeline.run_latest(spark, workdir)
    assert first.message == "OK" and first.records == 3
    again = pipeline.run_latest(spark, workdir)
    assert again.message == "No new data"
    st = SRC.read_state(spark, workdir).first()
    assert st["source_updated_at"] == dt.datetime(2026, 1, 26) and st["record_count"] == 3
    hist = spark.read.parquet(f"{workdir}/history")
    assert "job_description" not in hist.columns and hist.count() == 3


def test_new_snapshot_and_missing_processed(spark, workdir):
    land_snapshot(workdir, "2026-01-26", snap("2026-01-26", 2))
    pipeline.run_latest(spark, workdir)
    land_snapshot(workdir, "2026-01-27", snap("2026-01-27", 4))
    res = pipeline.run_latest(spark, workdir)
    assert res.snapshots == ["2026-01-27"] and res.records == 4
    latest = SRC.load_latest(spark, workdir)
    assert latest.count() == 4
    hist = spark.read.parquet(f"{workdir}/history")
    assert hist.groupBy("processed_date").count().count() == 2 and hist.count() == 6


def test_reprocess_all(spark, workdir):
    land_snapshot(workdir, "2026-01-26", snap("2026-01-26", 2))
    land_snapshot(workdir, "2026-01-27", snap("2026-01-27", 3))
    res = pipeline.reprocess_all(spark, workdir)
    assert res.snapshots == ["2026-01-26", "2026-01-27"]
    assert SRC.read_processed(spark, workdir).count() == 5
    assert spark.read.parquet(f"{workdir}/history").count() == 5
    assert SRC.read_state(spark, workdir).first()["record_count"] == 3


def test_pipeline_builds_index_of_latest(spark, workdir):
    from snapfacet.operators import predicates as P
    from snapfacet.operators import search as S

    land_snapshot(workdir, "2026-01-26", snap("2026-01-26", 2) + [raw_posting(job_id="9", business_title="Senior Plumber")])
    pipeline.run_latest(spark, workdir, build_index=True)
    idx = pipeline.load_latest_index(spark, workdir)
    jobs = SRC.load_latest(spark, workdir)
    rows, total = S.search(jobs, P.SearchSpec.postings(search="plumbers", use_index=True), index=idx).collect()
    assert total == 1 and rows[0]["job_id"] == "9"


def test_empty_state_and_load_error(spark, workdir):
    st = SRC.read_state(spark, workdir).first()
    assert st["source_updated_at"] is None and st["record_count"] is None
    with pytest.raises(ValueError):
        SRC.load_latest(spark, workdir)


def test_json_array_file_and_absent_key(spark, workdir):
    recs = snap("2026-01-26", 2)
    del recs[1]["post_until"]
    path = f"{workdir}/arr.json"
    with open(path, "w") as f:
        json.dump(recs, f)
    df = SRC.read_raw_snapshot(spark, path, multiline=True)
    assert df.count() == 2 and df.where(F.col("post_until").isNull()).count() == 1
    probe = SRC.probe_snapshot_date(df).first()
    assert probe["process_date"] == "2026-01-26T00:00:00.000" and probe["n_dates"] == 1


def test_landed_pages_report(spark, workdir):
    write_json_lines(f"{workdir}/pages/page-000.json", snap("2026-01-26", 3))
    write_json_lines(f"{workdir}/pages/page-001.json", snap("2026-01-26", 1))
    recs, report = SRC.read_landed_pages(spark, f"{workdir}/pages", page_size=3)
    assert recs.count() == 4
    assert all(r["ok"] for r in report.collect())
    dups = SRC.duplicate_records(recs)
    assert dups.count() == 1  # job 700000 appears on both pages, reported not dropped


def test_rekey_plan_actions(spark):
    files = spark.createDataFrame(
        [
            ("raw/a.json", "raw/T1.json"),
            ("raw/b.json", "raw/T1.json"),
            ("raw/T2.json", "raw/T2.json"),
            ("raw/a2.json", "raw/T2.json"),
            ("raw/z.json", "raw/T3.json"),
            ("raw/none.json", None),
        ],
        "file string, target string",
    )
    got = {r["file"]: r["action"] for r in H.rekey_plan(files).collect()}
    assert got == {
        "raw/a.json": "RENAME",
        "raw/b.json": "DELETE",
        "raw/T2.json": "SKIP",
        "raw/a2.json": "DELETE",
        "raw/z.json": "RENAME",
        "raw/none.json": "SKIP",
    }


def test_snapshot_gate_and_metrics(spark):
    ev = spark.createDataFrame(
        [(1, dt.date(2026, 1, 1)), (2, dt.date(2026, 1, 1)), (1, dt.date(2026, 1, 2)), (3, dt.date(2026, 1, 2)), (1, dt.date(2026, 1, 3))],
        "u long, day date",
    )
    existing = spark.createDataFrame([(dt.date(2026, 1, 1),)], "day date")
    assert sorted(r["day"] for r in H.snapshot_gate(ev, existing, "day").collect()) == [dt.date(2026, 1, 2), dt.date(2026, 1, 3)]
    m = {r["day"]: (r["present"], r["new"], r["gone"]) for r in H.history_metrics(ev, "day", "u").collect()}
    spans = {r["u"]: (r["first_seen"].day, r["last_seen"].day, r["snapshots"], r["days_open"]) for r in H.days_open(ev, "day", "u").collect()}
    assert spans == {1: (1, 3, 3, 3), 2: (1, 1, 1, 1), 3: (2, 2, 1, 1)}
    assert m == {dt.date(2026, 1, 1): (2, 2, 0), dt.date(2026, 1, 2): (2, 1, 1), dt.date(2026, 1, 3): (1, 0, 1)}
    assert {r["day"]: r["record_count"] for r in H.snapshot_counts(ev, "day").collect()}[dt.date(2026, 1, 1)] == 2


def test_intake_stream_takes_only_new(spark, workdir):
    landing, out, ckpt = f"{workdir}/landing", f"{workdir}/out", f"{workdir}/ckpt"
    from pyspark.sql import types as T

    schema = T.StructType(RAW.fields + [T.StructField("day", T.DateType(), True)])
    first = spark.createDataFrame(snap("2026-01-26", 2), RAW).withColumn("day", F.lit(dt.date(2026, 1, 26)))
    R.land(first, landing, "day")
    assert R.intake(spark, landing, out, ckpt, schema, "day") == 1
    assert R.intake(spark, landing, out, ckpt, schema, "day") == 0  # nothing new
    second = spark.createDataFrame(snap("2026-01-26", 1, agency="LATE"), RAW).withColumn("day", F.lit(dt.date(2026, 1, 26)))
    R.land(second, landing, "day", append=True)
    assert R.intake(spark, landing, out, ckpt, schema, "day") == 1
    # the late file of the same snapshot is added; the snapshot is rewritten whole
    assert spark.read.parquet(out).count() == 3
    assert os.path.isdir(out)
    # landing a snapshot again replaces it
    R.land(first, landing, "day")
    assert R.intake(spark, landing, out, ckpt, schema, "day") == 1
    assert spark.read.parquet(out).count() == 2


def test_a_late_snapshot_does_not_move_the_state_back(spark, workdir):
    land_snapshot(workdir, "2026-01-27", snap("2026-01-27", 2))
    pipeline.run_latest(spark, workdir, fetched_at=dt.datetime(2026, 1, 28))
    land_snapshot(workdir, "2026-01-26", snap("2026-01-26", 5))
    assert pipeline.run_latest(spark, workdir, fetched_at=dt.datetime(2026, 1, 29)).records == 5
    st = SRC.read_state(spark, workdir).first()
    assert (st["snapshot"], st["record_count"], st["source_updated_at"]) == ("2026-01-27", 2, dt.datetime(2026, 1, 27))
    assert SRC.load_latest(spark, workdir).count() == 2
    # reprocessing keeps the time of the last fetch
    pipeline.reprocess_all(spark, workdir)
    assert SRC.read_state(spark, workdir).first()["last_fetched_at"] == dt.datetime(2026, 1, 29)


def test_undated_records_and_two_snapshots_of_a_day(spark, workdir):
    raw = spark.createDataFrame(
        [raw_posting(process_date=d) for d in ("2026-01-26T06:00:00.000", "2026-01-26T18:00:00.000", None, "")], RAW
    )
    SRC.write_raw(raw, workdir)
    assert SRC.list_keys(spark, f"{workdir}/raw") == ["2026-01-26T06-00-00", "2026-01-26T18-00-00", "undated"]
    res = pipeline.run_latest(spark, workdir, lenient=True)
    assert res.records == 4 and SRC.read_state(spark, workdir).first()["snapshot"] == "2026-01-26T18-00-00"
    assert pipeline.run_latest(spark, workdir).message == "No new data"
    assert SRC.load_latest(spark, workdir).count() == 1


def test_the_raw_scan_reads_new_snapshots_only(spark, workdir):
    for day in ("2026-01-26", "2026-01-27"):
        land_snapshot(workdir, day, snap(day, 1))
    plan = SRC.read_raw(spark, workdir, keys=["2026-01-27"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot" in plan and "2026-01-27" in plan
    assert SRC.read_raw(spark, workdir, keys=["2026-01-27"]).count() == 1


def test_json_array_snapshots_through_the_pipeline(spark, workdir):
    path = f"{workdir}/raw/{SRC.SNAPSHOT}=2026-01-26"
    os.makedirs(path)
    with open(f"{path}/part.json", "w") as f:
        json.dump(snap("2026-01-26", 3), f, indent=1)
    assert pipeline.run_latest(spark, workdir, multiline=True).records == 3


def test_the_last_page_is_the_one_with_the_largest_number(spark, workdir):
    for n in (1, 2, 9, 10):
        write_json_lines(f"{workdir}/pages/page-{n}.json", snap("2026-01-26", 1 if n == 10 else 2))
    _, report = SRC.read_landed_pages(spark, f"{workdir}/pages", page_size=2)
    rows = {r["page"]: r for r in report.collect()}
    assert rows[10]["last"] and not rows[9]["last"] and all(r["ok"] for r in rows.values())


def test_pages_landed_twice_are_compressed_files(spark, workdir, monkeypatch):
    from snapfacet.plans import queries_pipeline as Q

    monkeypatch.setattr(Q, "scratch", lambda *_: workdir)
    got = Q.landed_records(spark, SF_SMALL).collect()
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet").join(spark.read.parquet(f"{SF_SMALL}/customer.parquet"), F.expr("o_custkey = c_custkey"))
    assert sorted(r["job_id"] for r in got) == sorted(str(r[0]) for r in orders.select("o_orderkey").collect())
    assert {r["copies"] for r in got} == {1}
    landed = [r["path"] for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json*").load(f"{workdir}/landed").select("path").collect()]
    assert landed and all(p.endswith(".json.snappy") for p in landed)
    records, report = SRC.read_landed_pages(spark, f"{workdir}/landed", page_size=2000)
    assert records.count() == 2 * len(got) and report.select("page").distinct().count() == len(landed)  # a page is one file
