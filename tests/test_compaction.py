"""Fact compaction: few files near the target, the same rows for readers at any moment, crashes."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from earshot.operators import facts
from earshot.plans import compaction as CO
from earshot.plans import fact as FT
from earshot.plans import load as L
from earshot.plans import refresh as RF
from earshot.plans import suite


def rows(df):
    return sorted(repr(tuple(r)) for r in df.select(*facts.FACT_COLUMNS).collect())


def store(spark, wh, ev, batches, first=0):
    """Batches of the fact, each committed, without the dimensions' jobs."""
    for b in range(first, first + batches):
        part = ev.where(F.col("event_id") % batches == b - first)
        L.write_fact(L.C.conform(facts.fact_listens(part, arrival="event_id"), L.FACT_LISTENS, loaded_at=suite.LOADED_AT),
                     L.table_path(wh, "fact_listens"), b)
        L.write_snapshot(spark.createDataFrame([(b, "fact_listens", 1)], "batch_id bigint, table_name string, rows bigint"),
                         L.table_path(wh, L.COMMITS), b)


def read(spark, wh):
    return FT.read_fact(spark, wh, L.committed_batch(spark, wh))


def files(path):
    return [p for p in path.rglob("*.parquet")]


def test_fifty_small_batches_become_few_files(spark, tmp_path):
    wh, ev = str(tmp_path / "wh"), suite._events(spark, SF_SMALL)
    store(spark, wh, ev, 50)
    before, small = rows(read(spark, wh)), files(tmp_path / "wh" / "fact_listens")
    old_reader = read(spark, wh)
    size = sum(p.stat().st_size for p in small)
    target = size // 20
    done = CO.compact_fact(spark, wh, target)
    assert done["files_before"] == len(small) and done["bytes_before"] == size
    new = files(tmp_path / "wh" / "fact_listens_runs" / "lo=0")
    days = len({p.parent.name for p in new})
    assert len(new) == done["files_after"] <= days + done["bins"] < len(small) / 10 and 15 < done["bins"] < 30
    assert rows(read(spark, wh)) == before and read(spark, wh).count() == len(before)
    assert rows(old_reader) == before                       # readers from before the swap
    one = spark.read.parquet(str(max(new, key=lambda p: p.stat().st_size))).toPandas()
    assert one.event_timestamp.is_monotonic_increasing
    assert CO.compact_fact(spark, wh, target) is None       # nothing new


def test_runs_merge_and_old_folders_go(spark, tmp_path):
    wh, ev = str(tmp_path / "wh"), suite._events(spark, SF_SMALL)
    thirds = [ev.where(F.col("event_id") % 3 == k) for k in range(3)]
    seen = []
    for k, part in enumerate(thirds):
        store(spark, wh, part, 4, first=4 * k)
        CO.compact_fact(spark, wh)
        seen.append([r[:2] for r in FT.live_runs(spark, wh)])
    assert seen[0] == [(0, 3)] and all(s[0][0] == 0 and s[-1][1] == 4 * k + 3 for k, s in enumerate(seen))
    assert all(a[1] + 1 == b[0] for s in seen for a, b in zip(s, s[1:]))
    assert rows(read(spark, wh)) == rows(facts.fact_listens(ev, arrival="event_id"))
    left = sorted(int(p.name[9:]) for p in (tmp_path / "wh" / "fact_listens").glob("batch_id=*"))
    assert left == [8, 9, 10, 11]                           # those that the marker before the last doesn't cover
    pruned = read(spark, wh).where(F.col("date_key") == 20240120)._jdf.queryExecution().executedPlan().toString()
    assert pruned.count("PartitionFilters") >= 1 and "20240120" in pruned.split("PartitionFilters", 1)[1][:300]
    late = FT.read_rows(spark, wh, L.committed_batch(spark, wh), above=7)
    assert {r[0] for r in late.select("batch_id").distinct().collect()} == {8, 9, 10, 11}


def test_crash_before_the_swap_shows_the_old_rows(spark, tmp_path, monkeypatch):
    wh, ev = str(tmp_path / "wh"), suite._events(spark, SF_SMALL)
    store(spark, wh, ev, 6)
    before = rows(read(spark, wh))
    monkeypatch.setattr(CO, "write_snapshot", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        CO.compact_fact(spark, wh)
    monkeypatch.undo()
    assert FT.live_runs(spark, wh) == [] and rows(read(spark, wh)) == before
    CO.clean(spark, wh)
    assert rows(read(spark, wh)) == before
    monkeypatch.setattr(CO, "clean", lambda *a: 1 / 0)       # behind the swap
    with pytest.raises(ZeroDivisionError):
        CO.compact_fact(spark, wh)
    monkeypatch.undo()
    assert [r[:2] for r in FT.live_runs(spark, wh)] == [(0, 5)] and rows(read(spark, wh)) == before


def test_marts_refresh_over_compacted_batches(spark, tmp_path):
    wh, ev = str(tmp_path / "wh"), suite._events(spark, SF_SMALL)
    for b in range(3):
        L.load_batch(ev.where(F.col("event_id") % 3 == b), b, wh, arrival="event_id", tie=["event_id"],
                     refreshes=[RF.refresh_tracks] if b == 0 else [])
    CO.compact_fact(spark, wh)
    RF.refresh_tracks(spark, wh)
    assert RF.read_tracks(spark, wh).agg(F.sum("total_events")).first()[0] == ev.count()


def test_bins_hold_the_target():
    rng = random.Random(3)
    days = [(20240101 + i, rng.randint(1, 200)) for i in range(200)] + [(None, 50), (20250101, 2501)]
    plan = CO.bins(days, 250)
    assert sorted((d or 0) for d, *_ in plan) == sorted((d or 0) for d, _ in days)
    held = {}
    for day, first, pieces in plan:
        for b in range(first, first + pieces):
            held[b] = held.get(b, 0) + dict(days)[day] / pieces
    assert max(held.values()) <= 251 and sorted(held) == list(range(len(held)))
    assert len(held) <= 1.15 * sum(s for _, s in days) / 250 + 1
    assert dict((d, p) for d, _, p in plan)[20250101] == 11
    assert CO.bins([], 10) == [] and CO.candidates([(0, 9, 1000), (10, 11, 40), (12, 12, 60)], 50) == [(12, 12, 60)][:0]
    assert CO.candidates([(0, 9, 1000), (10, 11, 40), (12, 12, 45)], 50) == [(10, 11, 40), (12, 12, 45)]
