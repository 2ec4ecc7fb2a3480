"""The command line drives the same jobs (run in-process on the test session)."""

from conftest import SF_SMALL
from earshot.__main__ import main
from earshot.plans import suite


def test_load_report_marts(spark, tmp_path):
    ev = suite._events(spark, SF_SMALL)
    src = tmp_path / "src"
    ev.drop("event_id").write.parquet(str(src / "part=0"))
    wh, ck = str(tmp_path / "wh"), str(tmp_path / "ck")
    out = main(["load", "--source", f"{src}/*", "--warehouse", wh, "--checkpoint", ck])
    assert out["tables"]["fact_listens"] == ev.count()
    rep = main(["report", "--warehouse", wh, "--as-of", "2024-02-10"])
    assert 0 < len(rep["rows"]) <= 10
    m = main(["marts", "--warehouse", wh])
    assert m["mv_daily_user_summary"] > 0 and m["mv_track_performance"] > 0


def test_file_row_arrival_separates_copies(spark, tmp_path):
    from earshot.plans import load as L
    ev = suite._events(spark, SF_SMALL).drop("event_id")
    src = tmp_path / "src"
    ev.unionByName(ev).write.parquet(str(src / "part=0"))      # every event twice
    wh, ck = str(tmp_path / "wh"), str(tmp_path / "ck")
    out = main(["load", "--source", f"{src}/*", "--warehouse", wh, "--checkpoint", ck,
                "--arrival", L.FILE_ROW])
    fact = L.read_star(spark, wh)["fact_listens"]
    assert out["tables"]["fact_listens"] == 2 * ev.count()
    assert fact.select("listen_key").distinct().count() == 2 * ev.count()


def test_ingest_and_compact(spark, tmp_path):
    import base64
    import json
    from earshot.streaming import ingest_stream as S, state as ST
    ev = {"user_id": "u1", "session_id": "s", "track_id": "t001", "action": "PLAY",
          "event_timestamp": "2024-01-15T10:30:00Z"}
    rec = {"kinesis": {"data": base64.b64encode(json.dumps(ev).encode()).decode(), "sequenceNumber": "1"}}
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.json").write_text(json.dumps({"Records": [rec, {"kinesis": {"data": "abc"}}]}) + "\n")
    root, ck = str(tmp_path / "state"), str(tmp_path / "ck")
    main(["ingest", "--source", str(src), "--root", root, "--checkpoint", ck])
    assert ST.latest_state(S.read_log(spark, root)).count() == 1
    assert main(["compact", "--root", root, "--as-of", "2024-01-16T00:00:00"])["kept"] == 1
    assert main(["compact", "--root", root, "--as-of", "2024-01-17T00:00:00"])["kept"] == 0


def test_compaction_versions_advance(spark, tmp_path):
    import base64
    import json
    from earshot.sinks.files import committed_versions
    from earshot.streaming import ingest_stream as S, state as ST

    def env(user, ts):
        e = {"user_id": user, "session_id": "s", "track_id": "t", "action": "PLAY", "event_timestamp": ts}
        return json.dumps({"Records": [{"kinesis": {
            "data": base64.b64encode(json.dumps(e).encode()).decode(), "sequenceNumber": "1"}}]}) + "\n"
    root, ck = str(tmp_path / "state"), str(tmp_path / "ck")
    for i, (u, ts) in enumerate([("u1", "2024-01-15T10:00:00Z"), ("u2", "2024-01-16T10:00:00Z")]):
        d = tmp_path / "in" / f"part={i}"
        d.mkdir(parents=True)
        (d / "a.json").write_text(env(u, ts))
        main(["ingest", "--source", str(tmp_path / "in" / "*"), "--root", root, "--checkpoint", ck])
        main(["compact", "--root", root, "--as-of", "2024-01-16T00:00:00"])
    assert committed_versions(spark, S.state_paths(root)["compacted"] + "/manifest") == [0, 1]
    assert {r.user_id for r in ST.latest_state(S.read_log(spark, root)).collect()} == {"u1", "u2"}


def test_missing_checkpoint_with_existing_tables_is_refused(spark, tmp_path):
    import pytest
    ev = suite._events(spark, SF_SMALL)
    src = tmp_path / "src"
    ev.drop("event_id").write.parquet(str(src / "part=0"))
    wh = str(tmp_path / "wh")
    main(["load", "--source", f"{src}/*", "--warehouse", wh, "--checkpoint", str(tmp_path / "ck")])
    with pytest.raises(RuntimeError, match="checkpoint"):
        main(["load", "--source", f"{src}/*", "--warehouse", wh, "--checkpoint", str(tmp_path / "other")])
