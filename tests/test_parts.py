"""Tables in parts: only touched parts are rewritten, readers keep a whole version, failed writes show nothing."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from earshot.plans import load as L
from earshot.plans import suite
from earshot.sinks import parts

LOADED = dt.datetime(2024, 3, 1)


def files(root):
    return {str(p.relative_to(root)): p.stat().st_mtime_ns for p in root.glob("data/v=*/part=*/*.parquet")}


def table(spark, keys, text):
    return spark.createDataFrame([(k, text) for k in keys], "k long, text string")


def rows(spark, root, **kw):
    return {r["k"]: r["text"] for r in parts.read_parts(spark, root, table(spark, [], "").schema, **kw).collect()}


def put(spark, root, keys, text, version):
    """Replace the parts of ``keys`` (by remainder of 8), with their other rows as they were."""
    touched = sorted({k % 8 for k in keys})
    before = parts.read_parts(spark, root, table(spark, [], "").schema, below=version, only=touched)
    both = before.join(table(spark, keys, text).select("k"), "k", "left_anti").unionByName(table(spark, keys, text))
    return parts.replace_parts(both, F.col("k") % 8, touched, root, version, ["k"])


def test_untouched_parts_keep_their_files(spark, tmp_path):
    root = str(tmp_path)
    assert put(spark, root, range(80), "a", 0) == 80
    first = files(tmp_path)
    old = parts.read_parts(spark, root, table(spark, [], "").schema, only=[3])
    assert put(spark, root, [3, 11, 100], "b", 1) == 81            # parts 3 and 4
    after = files(tmp_path)
    assert all(after[f] == at for f, at in first.items())           # nothing was rewritten in place
    assert {f.split("/")[2] for f in set(after) - set(first)} == {"part=3", "part=4"}
    now = rows(spark, root)
    assert len(now) == 81 and {k for k, t in now.items() if t == "b"} == {3, 11, 100}
    assert {r["text"] for r in old.collect()} == {"a"}              # a reader of the version before
    assert set(rows(spark, root, below=1).values()) == {"a"}


def test_unused_folders_go_and_used_ones_stay(spark, tmp_path):
    root = str(tmp_path)
    put(spark, root, range(80), "a", 0)
    for v in range(1, 5):
        put(spark, root, [3], f"v{v}", v)
    assert parts.drop_unused(spark, root, keep=2) == 3              # part 3 of versions 0, 1 and 2
    assert {f.split("/")[1] for f in files(tmp_path)} == {"v=0", "v=3", "v=4"}
    assert rows(spark, root)[3] == "v4" and rows(spark, root, below=4)[3] == "v3" and len(rows(spark, root)) == 80


def test_failed_write_is_not_seen_and_its_retry_replaces_it(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    put(spark, root, range(16), "a", 0)
    snapshot = parts.write_snapshot
    monkeypatch.setattr(parts, "write_snapshot", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        put(spark, root, [1, 2], "half", 1)
    monkeypatch.setattr(parts, "write_snapshot", snapshot)
    assert set(rows(spark, root).values()) == {"a"}
    assert parts.drop_unused(spark, root, keep=1) == 0              # a running write keeps its files
    put(spark, root, [2], "whole", 1)
    assert {k for k, t in rows(spark, root).items() if t != "a"} == {2}


def test_part_without_rows_is_gone(spark, tmp_path):
    root = str(tmp_path)
    put(spark, root, range(16), "a", 0)
    assert parts.replace_parts(table(spark, [], ""), F.col("k") % 8, [5], root, 1, ["k"]) == 14
    assert 5 not in parts.manifest(spark, root) and 5 not in rows(spark, root)
    with pytest.raises(ValueError):
        parts.replace_parts(table(spark, [1, 2], "x"), F.col("k") % 8, [1], root, 2, ["k"])


def test_a_load_rewrites_only_the_buckets_of_its_keys(spark, tmp_path):
    wh, ev = str(tmp_path / "wh"), suite._events(spark, SF_SMALL)
    L.load_batch(ev, 0, wh, arrival="event_id", tie=["event_id"], loaded_at=LOADED, dim_buckets={"dim_date": 1, "dim_tracks": 8, "dim_users": 64})
    root = tmp_path / "wh" / "dim_users"
    before = files(root)
    few = [r["user_id"] for r in ev.select("user_id").distinct().orderBy("user_id").limit(2).collect()]
    L.load_batch(ev.where(F.col("user_id").isin(few)), 1, wh, arrival="event_id", tie=["event_id"], loaded_at=dt.datetime(2024, 3, 2))
    after, held = files(root), parts.manifest(spark, str(root))
    assert all(after[f] == at for f, at in before.items())
    new = {f.split("/")[2] for f in set(after) - set(before)}
    assert 1 <= len(new) <= 2 and {f"part={p}" for p, (v, _) in held.items() if v == 1} == new
    assert len(held) > 5 and {v for v, _ in held.values()} == {0, 1}
    users = L.read_star(spark, wh)["dim_users"]
    assert users.count() == ev.select("user_id").distinct().count()
    assert {r["user_id"] for r in users.where(F.col("updated_at") == F.lit("2024-03-02").cast("timestamp_ntz")).collect()} == set(few)
