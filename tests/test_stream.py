"""Stream ingest: envelopes, batches, replays, last write wins, late data."""

import base64
import json
import os
import tempfile

from pyspark.sql import functions as F

from earshot.operators import ingest
from earshot.sources import files as R
from earshot.streaming import ingest_stream as S
from earshot.streaming import state as ST

EV = {"user_id": "u1", "session_id": "s", "track_id": "t001", "track_title": "T", "artist": "A",
      "action": "PLAY", "device_type": "MOBILE", "listen_duration_ms": 0,
      "event_timestamp": "2024-01-15T10:30:00Z"}


def rec(seq, **kw):
    data = base64.b64encode(json.dumps({**EV, **kw}).encode()).decode()
    return {"kinesis": {"data": data, "sequenceNumber": str(seq)}}


def write_lines(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        for line in lines:
            f.write(line + "\n")


def test_envelope_edges(spark):
    d = tempfile.mkdtemp(prefix="earshot-test-")
    write_lines(d, "a.json", ["{}", '{"Records":[]}', json.dumps({"Records": [{}]}),
                              json.dumps({"Records": [rec(1), rec(2, action="SKIP")]})])
    records = R.explode_envelopes(R.read_envelopes(spark, d))
    s = ingest.summary(ingest.parse_records(records)).collect()[0]
    assert (s.records_processed, s.records_failed) == (2, 1)


def run(spark, root, parts):
    for i, lines in enumerate(parts):
        write_lines(f"{root}/in/part={i}", "e.json", lines)
        S.start_ingest(spark, f"{root}/in/*", root, f"{root}/ckpt").awaitTermination()


def test_last_write_wins_and_replay(spark):
    root = tempfile.mkdtemp(prefix="earshot-test-")
    same_key = [json.dumps({"Records": [rec(1, action="PLAY"), rec(2, action="SKIP")]})]
    later = [json.dumps({"Records": [rec(3, action="COMPLETE", event_timestamp="2024-01-15T10:30:00.000Z"),
                                     rec(4, action="PAUSE", user_id="u2")]})]
    run(spark, root, [same_key, later])
    latest = {(r.user_id, r.timestamp): r.action for r in ST.latest_state(S.read_log(spark, root)).collect()}
    assert latest == {("u1", "2024-01-15T10:30:00Z"): "SKIP",
                      ("u1", "2024-01-15T10:30:00.000Z"): "COMPLETE",
                      ("u2", "2024-01-15T10:30:00Z"): "PAUSE"}
    # a re-run of batch 0 (as after a failure) replaces its partition: still one copy
    recs = R.explode_envelopes(R.read_envelopes(spark, f"{root}/in/part=0"))
    S.process_batch(recs, 0, root)
    assert S.read_log(spark, root).count() == 4
    # a later batch overwrites an earlier key
    run_more = [json.dumps({"Records": [rec(9, action="PAUSE")]})]
    write_lines(f"{root}/in/part=2", "e.json", run_more)
    S.start_ingest(spark, f"{root}/in/*", root, f"{root}/ckpt").awaitTermination()
    latest = {(r.user_id, r.timestamp): r.action for r in ST.latest_state(S.read_log(spark, root)).collect()}
    assert latest[("u1", "2024-01-15T10:30:00Z")] == "PAUSE"


def test_empty_and_all_bad_batches(spark):
    root = tempfile.mkdtemp(prefix="earshot-test-")
    run(spark, root, [["{}"], [json.dumps({"Records": [{"kinesis": {"data": "abc"}}]})]])
    summ = spark.read.parquet(S.state_paths(root)["summary"]).agg(
        F.sum("records_processed"), F.sum("records_failed")).collect()[0]
    assert tuple(summ) == (0, 1)
    dead = spark.read.parquet(S.state_paths(root)["dead"]).collect()
    assert [r.error for r in dead] == ["bad_base64"]


def test_late_event_kept_but_not_live(spark):
    root = tempfile.mkdtemp(prefix="earshot-test-")
    run(spark, root, [[json.dumps({"Records": [rec(1, event_timestamp="2024-01-13T10:30:00Z")]})]])
    latest = ST.latest_state(S.read_log(spark, root))
    import datetime as dt
    assert latest.count() == 1
    assert ST.live_state(latest, dt.datetime(2024, 1, 15)).count() == 0
    assert ST.live_state(latest, dt.datetime(2024, 1, 14)).count() == 1


def test_keyed_log_records_raw_payload(spark):
    """A Kafka-shaped batch (raw JSON bytes, offsets) goes through the same batch step."""
    root = tempfile.mkdtemp(prefix="earshot-test-")
    msgs = spark.createDataFrame(
        [("events", 0, 10, json.dumps(EV).encode()),
         ("events", 0, 11, json.dumps({**EV, "action": "SKIP"}).encode()),
         ("events", 1, 3, b"{bad")],
        "topic string, partition int, offset long, value binary")
    S.process_batch(S.keyed_log_records(msgs), 0, root, payload="payload")
    latest = ST.latest_state(S.read_log(spark, root)).collect()
    assert [(r.user_id, r.action) for r in latest] == [("u1", "SKIP")]
    dead = spark.read.parquet(S.state_paths(root)["dead"]).collect()
    assert [r.error for r in dead] == ["bad_json"]


def test_parquet_scan_arrival_is_unique(spark, tmp_path):
    from conftest import SF_SMALL
    from earshot.plans import suite
    ev = suite._events(spark, SF_SMALL)
    ev.write.parquet(str(tmp_path / "ev"))
    scanned = R.read_events(spark, str(tmp_path / "ev"), arrival=True)
    assert scanned.select("_arrival").distinct().count() == ev.count()


def test_compaction_then_newer_batch(spark):
    import datetime as dt
    root = tempfile.mkdtemp(prefix="earshot-test-")
    run(spark, root, [[json.dumps({"Records": [rec(1, action="PLAY"), rec(2, user_id="u2")]})]])
    kept = S.compact(spark, root, dt.datetime(2024, 1, 15))
    assert kept == 2
    # after compaction the old batch is not read again
    plan = S.read_log(spark, root)._jdf.queryExecution().executedPlan().toString()
    assert "state_compacted" in plan
    write_lines(f"{root}/in/part=9", "e.json", [json.dumps({"Records": [rec(5, action="SKIP")]})])
    S.start_ingest(spark, f"{root}/in/*", root, f"{root}/ckpt").awaitTermination()
    latest = {(r.user_id, r.action) for r in ST.latest_state(S.read_log(spark, root)).collect()}
    assert latest == {("u1", "SKIP"), ("u2", "PLAY")}


def test_envelopes_without_sequence_numbers_follow_line_order(spark):
    root = tempfile.mkdtemp(prefix="earshot-test-")

    def bare(**kw):
        return {"kinesis": {"data": base64.b64encode(json.dumps({**EV, **kw}).encode()).decode()}}
    lines = [json.dumps({"Records": [bare(action="PLAY"), bare(action="PAUSE")]}),
             json.dumps({"Records": [bare(action="SKIP")]}),
             json.dumps({"Records": [bare(action="COMPLETE", user_id="u2")]})]
    run(spark, root, [lines])
    latest = {r.user_id: r.action for r in ST.latest_state(S.read_log(spark, root)).collect()}
    assert latest == {"u1": "SKIP", "u2": "COMPLETE"}
