"""Atomic publication of history and state (S7, S8): readers find the last whole version."""

import datetime as dt
import os

import pytest

from snapfacet.plans import pipeline
from snapfacet.sources import snapshots as SRC
from snapfacet.sources import versions as V

from .test_pipeline import land_snapshot, snap


def frame(spark, rows):
    return spark.createDataFrame(rows, "snapshot string, n long")


def rows(df):
    return sorted(tuple(r) for r in df.select("snapshot", "n").collect())


def test_versions_keep_or_replace_partitions(spark, workdir):
    path = f"{workdir}/t"
    assert V.current(spark, path) is None and V.unreferenced(spark, path) == []
    with pytest.raises(ValueError):
        V.read(spark, path)
    V.replace(spark, path, frame(spark, [("2026-01-01", 1), ("2026-01-02", 2)]), "snapshot")
    first = V.current(spark, path)
    V.replace(spark, path, frame(spark, [("2026-01-02", 20), ("2026-01-03", 30)]), "snapshot", keep=True)
    assert rows(V.read(spark, path)) == [("2026-01-01", 1), ("2026-01-02", 20), ("2026-01-03", 30)]
    assert rows(V.read(spark, path, first)) == [("2026-01-01", 1), ("2026-01-02", 2)]  # a reader of the one before
    assert V.unreferenced(spark, path) == [f"version={first.id}/snapshot=2026-01-02"]
    V.replace(spark, path, frame(spark, [("2026-01-09", 9)]), "snapshot", note="rebuilt")
    assert rows(V.read(spark, path)) == [("2026-01-09", 9)] and V.current(spark, path).note == "rebuilt"
    assert V.unreferenced(spark, path, keep_last=3) == []


def test_unpublished_rows_are_not_read(spark, workdir):
    path = f"{workdir}/t"
    V.replace(spark, path, frame(spark, [("2026-01-01", 1)]), "snapshot")
    id_, folders = V.write(spark, path, frame(spark, [("2026-01-01", 2)]), "snapshot")  # the writer dies here
    os.makedirs(f"{path}_commits/commit=000000009-dead/_temporary/0")
    assert rows(V.read(spark, path)) == [("2026-01-01", 1)]
    assert V.unreferenced(spark, path) == [f for _, f in folders]
    V.replace(spark, path, frame(spark, [("2026-01-01", 3)]), "snapshot")  # the next run, beside the dead one's rows
    assert rows(V.read(spark, path)) == [("2026-01-01", 3)]
    V.publish(spark, path, id_, folders, "snapshot")  # a slow writer that publishes late has the last word
    assert rows(V.read(spark, path)) == [("2026-01-01", 2)]


def test_table_without_key_and_without_rows(spark, workdir):
    V.replace(spark, f"{workdir}/t", frame(spark, [("a", 1)]))
    assert rows(V.read(spark, f"{workdir}/t")) == [("a", 1)]
    V.replace(spark, f"{workdir}/u", frame(spark, []), "snapshot")
    assert V.read(spark, f"{workdir}/u", schema="snapshot string, n long").count() == 0


def test_state_after_crash(spark, workdir):
    """Half-written versions, in every way a writer can leave them, do not hide the state before."""
    assert SRC.read_state(spark, workdir).first()["snapshot"] is None
    SRC.write_state(spark, workdir, None, None, dt.datetime(2026, 1, 1), 3, "2026-01-01")
    SRC.write_state(spark, workdir, None, None, dt.datetime(2026, 1, 2), 4, "2026-01-02")
    os.makedirs(f"{workdir}/state/version=99990101T000000.000000-dead/_temporary/0/task")
    with open(f"{workdir}/state/version=99990101T000000.000000-dead/_temporary/0/task/part-0.json", "w") as f:
        f.write('{"snapshot":"2027-01-01"}')
    os.makedirs(f"{workdir}/state/version=99990102T000000.000000-dead")
    with open(f"{workdir}/state/version=99990102T000000.000000-dead/part-0.json", "w") as f:
        f.write('{"snapshot":"2027-0')
    os.makedirs(f"{workdir}/state/version=99990103T000000.000000-dead")
    open(f"{workdir}/state/version=99990103T000000.000000-dead/part-0.json", "w").close()
    st = SRC.read_state(spark, workdir).first()
    assert (st["snapshot"], st["record_count"]) == ("2026-01-02", 4)


def test_state_of_an_earlier_layout_is_read(spark, workdir):
    os.makedirs(f"{workdir}/state")
    with open(f"{workdir}/state/part-0.json", "w") as f:
        f.write('{"snapshot":"2025-01-01","record_count":1}')
    assert SRC.read_state(spark, workdir).first()["snapshot"] == "2025-01-01"
    SRC.write_state(spark, workdir, None, None, None, 2, "2026-01-01")
    assert SRC.read_state(spark, workdir).first()["snapshot"] == "2026-01-01"


def test_failed_rebuild_leaves_the_history(spark, workdir, monkeypatch):
    """A reader that looks while the history is rebuilt, or after the rebuild has failed, sees all of it."""
    for day, n in (("2026-01-26", 2), ("2026-01-27", 3)):
        land_snapshot(workdir, day, snap(day, n))
        pipeline.run_latest(spark, workdir)
    before = SRC.read_history(spark, workdir)
    assert before.count() == 5
    seen = []

    def dies(*args, **kw):
        seen.append(SRC.read_history(spark, workdir).count())
        raise RuntimeError("executor lost")

    monkeypatch.setattr(V, "publish", dies)
    with pytest.raises(RuntimeError):
        pipeline.rebuild_history(spark, workdir)
    monkeypatch.undo()
    assert seen == [5] and SRC.read_history(spark, workdir).count() == 5
    assert pipeline.rebuild_history(spark, workdir).count() == 5
    assert before.count() == 5  # a reader that began with the version before
    land_snapshot(workdir, "2026-01-28", snap("2026-01-28", 4))
    pipeline.run_latest(spark, workdir)
    assert sorted(r[0] for r in SRC.read_history(spark, workdir).select("snapshot").distinct().collect()) == ["2026-01-26", "2026-01-27", "2026-01-28"]
