"""Validity intervals: the same table in whatever order snapshots come; changes against plain Python."""

import itertools
import random

import pytest

from snapfacet.operators.intervals import IntervalTable
from snapfacet.sources import versions as V


def plain(snapshots):
    """Intervals (entity, content, first, last, valid_to) of {key: set of pairs}."""
    keys, out = sorted(snapshots), []
    for pair in set().union(*snapshots.values()):
        start = None
        for i, k in enumerate([*keys, None]):
            here = k is not None and pair in snapshots[k]
            if here and start is None:
                start = k
            if not here and start is not None:
                out.append((*pair, start, keys[i - 1], k))
                start = None
    return sorted(out, key=str)


def plain_changes(snapshots):
    keys, out, seen = sorted(snapshots), [], set()
    jobs = lambda k: {j for j, _ in snapshots[k] if j is not None}
    of = lambda k, j: {c for i, c in snapshots[k] if i == j}
    for p, k in zip([None, *keys], keys):
        for j in jobs(k) | (jobs(p) if p else set()):
            old, new = of(p, j) if p else set(), of(k, j)
            if old != new and p:
                change = "closed" if not new else "changed" if old else "reopened" if j in seen else "new"
                out.append((k, j, change, len(new)))
        seen |= jobs(k)
    return sorted(out)


def made(seed, days=5):
    rng = random.Random(seed)
    pairs = [(f"j{j}", f"c{c}") for j in range(6) for c in range(2)] + [("j9", None), (None, "c0")]
    return {f"2026-01-0{d + 1}": {p for p in pairs if rng.random() < 0.55} for d in range(days)}


def frame(spark, pairs):
    rows = [*pairs, *list(pairs)[:3]]  # repeated rows
    return spark.createDataFrame([(j, c, "x") for j, c in rows], "job_id string, content_id string, more string")


def got(table):
    return sorted((tuple(r) for r in table.intervals().select("job_id", "content_id", "first_seen", "last_seen", "valid_to").collect()), key=str)


@pytest.mark.parametrize("order", [(0, 1, 2, 3, 4), (4, 0, 2, 1, 3), (3, 1, 4, 2, 0)])
def test_any_order_gives_one_table(spark, workdir, order):
    snapshots = made(1)
    keys = sorted(snapshots)
    table = IntervalTable(spark, f"{workdir}/t")
    for n, i in enumerate(order):
        table.add(frame(spark, snapshots[keys[i]]), keys[i])
        if n in (2, 4):
            some = {keys[j]: snapshots[keys[j]] for j in order[: n + 1]}
            assert got(table) == plain(some)
    assert sorted(tuple(r) for r in table.changes().collect()) == plain_changes(snapshots)
    for k in keys[::2]:
        assert sorted((tuple(r) for r in table.as_of(k).collect()), key=str) == sorted(snapshots[k], key=str)


def test_a_snapshot_added_again_is_replaced(spark, workdir):
    snapshots = made(2, 4)
    table = IntervalTable(spark, f"{workdir}/t")
    for k in sorted(snapshots):
        table.add(frame(spark, snapshots[k]), k)
    for k, pairs in (("2026-01-02", made(3)["2026-01-01"]), ("2026-01-04", set()), ("2026-01-01", snapshots["2026-01-03"])):
        snapshots[k] = pairs
        table.add(frame(spark, pairs), k)
        assert got(table) == plain(snapshots)
    assert table.snapshots() == sorted(snapshots)


def test_only_touched_partitions_are_written(spark, workdir):
    table = IntervalTable(spark, f"{workdir}/t")
    table.add(frame(spark, {("a", "1"), ("b", "1")}), "2026-01-01")
    table.add(frame(spark, {("a", "1")}), "2026-01-02")
    before = dict(V.current(spark, f"{workdir}/t").folders)
    table.add(frame(spark, {("a", "1"), ("c", "1")}), "2026-01-03")
    after = dict(V.current(spark, f"{workdir}/t").folders)
    assert after["2026-01-01"] == before["2026-01-01"] and set(after) == {"2026-01-01", "2026-01-03"}


def test_empty(spark, workdir):
    table = IntervalTable(spark, f"{workdir}/t")
    with pytest.raises(ValueError):
        table.intervals()
    assert table.snapshots() == []


def test_reading_a_snapshot_prunes_partitions(spark, workdir):
    table = IntervalTable(spark, f"{workdir}/t")
    for d, pairs in itertools.islice(made(5).items(), 3):
        table.add(frame(spark, pairs), d)
    plan = table.as_of("2026-01-03")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(last_seen" in plan or "last_seen" in plan.split("PartitionFilters:")[1].split("]")[0]


def test_pipeline_intervals(spark, workdir):
    """A posting that changes its title, one that closes, one that opens; the middle snapshot comes late."""
    from snapfacet.plans import pipeline

    from .conftest import raw_posting
    from .test_pipeline import land_snapshot

    days = {
        "2026-01-26": {"1": "clerk", "2": "nurse"},
        "2026-01-27": {"1": "clerk", "2": "nurse", "3": "baker"},
        "2026-01-28": {"1": "head clerk", "3": "baker"},
    }
    for day in ("2026-01-26", "2026-01-28", "2026-01-27"):
        land_snapshot(workdir, day, [raw_posting(job_id=j, business_title=t, process_date=f"{day}T00:00:00.000") for j, t in days[day].items()])
        table = pipeline.update_intervals(spark, workdir, pipeline.run_latest(spark, workdir).snapshots)
    spans = sorted((r["job_id"], r["valid_from"], r["valid_to"]) for r in table.intervals().collect())
    assert spans == [("1", "2026-01-26", "2026-01-28"), ("1", "2026-01-28", None), ("2", "2026-01-26", "2026-01-28"), ("3", "2026-01-27", None)]
    changes = sorted((r["snapshot"], r["job_id"], r["change"]) for r in table.changes().collect())
    assert changes == [("2026-01-27", "3", "new"), ("2026-01-28", "1", "changed"), ("2026-01-28", "2", "closed")]
