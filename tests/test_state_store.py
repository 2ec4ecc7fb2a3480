"""Compacted state in buckets: point reads, rewritten buckets, expiry."""

import json

from pyspark.sql import functions as F

from earshot.sinks import parts
from earshot.streaming import ingest_stream as S
from earshot.streaming import state as ST
from test_stream import rec, write_lines

DAY = 86_400


def ingest(spark, root, name, users, **fields):
    write_lines(f"{root}/in", f"{name}.json", [json.dumps({"Records": [rec(i, user_id=u, **fields)]}) for i, u in enumerate(users)])
    S.start_ingest(spark, f"{root}/in", root, f"{root}/ckpt").awaitTermination()


def items(df):
    return sorted((r.user_id, r.timestamp, r.action) for r in df.collect())


def files(df, kind):
    return {f.split(f"/{kind}/")[1] for f in df.inputFiles() if f"/{kind}/" in f}


def test_a_lookup_reads_one_bucket(spark, tmp_path):
    root, users = str(tmp_path), [f"u{i}" for i in range(60)]
    ingest(spark, root, "a", users, action="PLAY")
    ingest(spark, root, "b", users[:30], action="PAUSE")
    S.compact(spark, root, 0)
    ingest(spark, root, "c", ["u7", "u50"], action="SKIP")
    every = {u: [x for x in items(ST.latest_state(S.read_log(spark, root))) if x[0] == u] for u in users}
    for user in ("u3", "u7", "u45", "u50", "nobody"):
        found = S.lookup(spark, root, user)
        assert items(found) == every.get(user, [])
        assert len({f.split("/")[1] for f in files(found, "data")}) <= 1            # one bucket
        scan = found._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(batch_id" in scan and "> 1)]" in scan      # newer batches alone
    one = S.lookup(spark, root, "u7", every["u7"][0][1])
    assert items(one) == every["u7"]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert plan.count("EqualTo(user_id,u7)") >= 2 and "EqualTo(timestamp" in plan   # pushed to both scans
    assert S.lookup(spark, root, "u7", "1999-01-01").count() == 0
    assert S.lookup(spark, root, "u7", as_of=2 ** 40).count() == 0


def test_compaction_rewrites_only_buckets_of_new_items(spark, tmp_path):
    root, users = str(tmp_path), [f"u{i}" for i in range(60)]
    store = tmp_path / "state_compacted"
    ingest(spark, root, "a", users, action="PLAY")
    assert S.compact(spark, root, 0) == 60
    before = {p: p.stat().st_mtime_ns for p in store.glob("data/v=0/part=*/*.parquet")}
    ingest(spark, root, "b", ["u7"], action="SKIP")
    assert S.compact(spark, root, 0) == 60
    new = {p.parent.name for p in store.glob("data/v=1/part=*/*.parquet")}
    assert len(new) == 1 and all(p.stat().st_mtime_ns == t for p, t in before.items() if p.exists())
    held = parts.manifest(spark, str(store))
    assert sorted(v for v, _ in held.values()).count(1) == 1 and len(held) > 5
    assert dict((u, a) for u, _, a in items(ST.latest_state(S.read_log(spark, root))))["u7"] == "SKIP"


def test_expired_buckets_are_dropped(spark, tmp_path):
    root = str(tmp_path)
    store = f"{root}/state_compacted"
    ingest(spark, root, "a", [f"u{i}" for i in range(40)], event_timestamp="2024-01-10T10:00:00Z")
    ends = ST.latest_state(S.read_log(spark, root)).agg(F.max("ttl")).first()[0]
    S.compact(spark, root, ends - 10)
    assert len(parts.manifest(spark, store)) > 5
    ingest(spark, root, "b", ["u1"], event_timestamp="2024-01-12T10:00:00Z")
    assert S.compact(spark, root, ends + 10) == 1
    assert len(parts.manifest(spark, store)) == 1                       # the one with the new item
    assert items(ST.latest_state(S.read_log(spark, root)))[0][0] == "u1"
    ingest(spark, root, "c", ["u2"], event_timestamp="2024-01-01T10:00:00Z")
    assert S.compact(spark, root, ends + 3 * DAY) == 0                  # all of it has expired
    assert S.lookup(spark, root, "u1", as_of=ends + 3 * DAY).count() == 0
