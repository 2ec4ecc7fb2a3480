"""Incremental marts: equal to the full ones, work in proportion to the new batches, safe to retry."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from earshot.operators import marts
from earshot.plans import load as L
from earshot.plans import refresh as RF
from earshot.plans import suite
from earshot.sinks import parts


def load(ev, batch, wh, **options):
    L.load_batch(ev, batch, wh, arrival="event_id", tie=["event_id"], **options)


def rows(df):
    return sorted(repr(tuple(r)) for r in df.select(*sorted(df.columns)).collect())


def full(spark, wh):
    star = L.read_star(spark, wh)
    return (rows(marts.daily_user_summary(star["fact_listens"], star["dim_users"], star["dim_date"])),
            rows(marts.track_performance(star["fact_listens"], star["dim_tracks"])))


def stored(spark, wh):
    return rows(RF.read_daily(spark, wh)), rows(RF.read_tracks(spark, wh))


def numbers(spark, wh):
    """Without titles and artists, which are always the present ones."""
    return rows(RF.read_daily(spark, wh)), rows(RF.read_tracks(spark, wh).drop("title", "artist"))


def test_marts_equal_the_full_ones_after_every_load(spark, tmp_path):
    wh, ev = str(tmp_path / "wh"), suite._events(spark, SF_SMALL)
    for batch in range(3):
        load(ev.where(F.col("event_id") % 3 == batch), batch, wh, refreshes=[RF.refresh_daily, RF.refresh_tracks])
        assert stored(spark, wh) == full(spark, wh)
    assert RF.refresh_tracks(spark, wh) == RF.read_tracks(spark, wh).count()            # nothing new: nothing done
    assert parts.newest(spark, L.table_path(wh, RF.TRACKS)) == 2


def test_batches_between_two_refreshes_are_caught_up(spark, tmp_path):
    wh, ev = str(tmp_path / "wh"), suite._events(spark, SF_SMALL)
    assert RF.refresh_daily(spark, wh) == RF.refresh_tracks(spark, wh) == 0             # before any load
    load(ev.where("event_id % 2 = 0"), 0, wh, refreshes=[RF.refresh_daily, RF.refresh_tracks])
    before = numbers(spark, wh)
    late = ev.where("event_id % 2 = 1")
    first, last = (late.agg(f("event_timestamp")).first()[0].date() for f in (F.min, F.max))
    load(late.where(F.to_date("event_timestamp") == F.lit(first)), 1, wh)
    load(late.where(F.to_date("event_timestamp") == F.lit(last)), 2, wh)
    assert numbers(spark, wh) == before and stored(spark, wh) != full(spark, wh)
    assert RF.stale_days(spark, wh) == sorted(int(d.strftime("%Y%m%d")) for d in (first, last))
    RF.refresh_daily(spark, wh)
    RF.refresh_tracks(spark, wh)
    assert stored(spark, wh) == full(spark, wh) and RF.stale_days(spark, wh) == []
    held = parts.manifest(spark, L.table_path(wh, RF.DAILY))
    assert {p for p, (v, _) in held.items() if v == 2} == {int(d.strftime("%Y%m%d")) for d in (first, last)}   # other days' files stay


def test_failed_refresh_shows_nothing_and_its_retry_counts_once(spark, tmp_path, monkeypatch):
    wh, ev = str(tmp_path / "wh"), suite._events(spark, SF_SMALL)
    load(ev.where("event_id % 2 = 0"), 0, wh, refreshes=[RF.refresh_daily, RF.refresh_tracks])
    before = numbers(spark, wh)
    load(ev.where("event_id % 4 = 1"), 1, wh)
    monkeypatch.setattr(parts, "write_snapshot", lambda *a, **k: 1 / 0)
    for refresh in (RF.refresh_daily, RF.refresh_tracks):                               # fails with its files and pairs written
        with pytest.raises(ZeroDivisionError):
            refresh(spark, wh)
    monkeypatch.undo()
    assert numbers(spark, wh) == before
    load(ev.where("event_id % 4 = 3"), 2, wh, refreshes=[RF.refresh_daily, RF.refresh_tracks])
    assert stored(spark, wh) == full(spark, wh)


def test_pairs_met_before_are_not_shuffled(spark, tmp_path):
    wh, ev = str(tmp_path / "wh"), suite._events(spark, SF_SMALL)
    load(ev.where("event_id % 10 > 0"), 0, wh, refreshes=[RF.refresh_tracks])
    load(ev.where("event_id % 10 = 0"), 1, wh)
    events = RF.newer_events(spark, wh, RF.TRACKS)
    new = RF.new_pairs(spark, wh, events, 0)
    plan = new._jdf.queryExecution().executedPlan().toString()
    held = plan.split("SortMergeJoin", 1)[1].split("Exchange")[-1]                      # below the last exchange: the stored pairs
    assert "Bucketed: true" in plan and "Bucketed: true" in held and plan.count("hashpartitioning") == 2, plan
    every = L.read_star(spark, wh)["fact_listens"].select("track_key", "user_key").distinct().count()
    assert new.count() == every - spark.table(RF.listeners_table(spark, wh)).count()
    scan = events._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in scan and "batch_id" in scan.split("PartitionFilters", 1)[1][:200]   # only newer batches are read
