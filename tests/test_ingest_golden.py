"""Golden rows for record ingest (FIXTURES.md §4)."""

import base64
import json

import pytest

from earshot.operators import ingest

OK = {"user_id": "user_00001", "session_id": "sess_abc", "track_id": "t001",
      "track_title": "Song", "artist": "Band", "action": "PLAY", "device_type": "MOBILE",
      "listen_duration_ms": 45000, "event_timestamp": "2024-01-15T10:30:00Z"}
OKJ = json.dumps(OK)


def b64(x):
    return base64.b64encode(x.encode() if isinstance(x, str) else x).decode()


def without(*keys):
    return json.dumps({k: v for k, v in OK.items() if k not in keys})


def with_(**kw):
    return json.dumps({**OK, **kw})


CASES = [
    ("ok", b64(OKJ), None),
    ("not_base64", "!!!", "bad_json"),
    ("foreign_char", b64(OKJ)[:8] + "!" + b64(OKJ)[8:], None),
    ("no_padding", "abc", "bad_base64"),
    ("short_padding", "YQ=", "bad_base64"),
    ("not_utf8", b64(b"\xff\xfe" + OKJ.encode()), "bad_utf8"),
    ("broken", b64("{bad"), "bad_json"),
    ("trailing_text", b64(OKJ + " x"), "bad_json"),
    ("two_objects", b64(OKJ + OKJ), "bad_json"),
    ("comma_two", b64(OKJ + "," + OKJ), "bad_json"),
    ("bracket_text", b64(OKJ + "] x"), "bad_json"),
    ("single_quotes", b64("{'user_id': 'u'}"), "bad_json"),
    ("trailing_comma", b64(OKJ[:-1] + ",}"), "bad_json"),
    ("raw_tab", b64(OKJ.replace("sess_abc", "sess\tabc")), "bad_json"),
    ("newline_after", b64(OKJ + "\n"), None),
    ("base64_then_newline", b64(OKJ) + "\n", None),
    ("ts_then_newline", b64(with_(event_timestamp="2024-01-15\n")), "bad_timestamp"),
    ("bom", b64("\ufeff" + OKJ), None),
    ("nan", b64(OKJ.replace("45000", "NaN")), "bad_json"),
    ("true_duration", b64(OKJ.replace("45000", "true")), "bad_duration"),
    ("array", b64("[1]"), "not_object"),
    ("number", b64("5"), "not_object"),
    ("null_session", b64(with_(session_id=None)), None),
    ("null_user", b64(with_(user_id=None)), "null_key"),
    ("null_duration", b64(with_(listen_duration_ms=None)), "bad_duration"),
    ("text_duration", b64(with_(listen_duration_ms="abc")), "bad_duration"),
    ("ts_null", b64(with_(event_timestamp=None)), "bad_timestamp"),
] + [(f"missing_{f}", b64(without(f)), f"missing:{f}")
     for f in ["user_id", "session_id", "track_id", "action", "event_timestamp"]] + [
    (f"ts_{t}", b64(with_(event_timestamp=t)), "bad_timestamp")
    for t in ["junk", "12:00", "2024", "2024-1-5T10:30:00Z", "2024-02-30T10:00:00Z"]]


@pytest.fixture(scope="module")
def parsed(spark):
    df = spark.createDataFrame([(n, d) for n, d, _ in CASES], "name string, data string")
    return {r.name: r for r in ingest.parse_records(df).collect()}


@pytest.mark.parametrize("name,data,error", CASES, ids=[c[0] for c in CASES])
def test_error_code(parsed, name, data, error):
    assert parsed[name].error == error


def one(spark, payload):
    df = spark.createDataFrame([(b64(payload),)], "data string")
    return ingest.parse_records(df).collect()[0]


def test_ttl_of_ok(spark):
    assert one(spark, OKJ).ttl == 1705401000


def test_defaults_for_absent_fields(spark):
    r = one(spark, without("artist", "device_type", "track_title", "listen_duration_ms"))
    assert (r.error, r.artist, r.track_title, r.device_type) == (None, "Unknown", "Unknown", "UNKNOWN")
    assert str(r.listen_duration_ms) == "0E-9" or float(r.listen_duration_ms) == 0


def test_null_is_not_absent(spark):
    r = one(spark, with_(artist=None))
    assert r.error is None and r.artist is None


def test_fractional_duration_exact(spark):
    assert str(one(spark, with_(listen_duration_ms=45000.5)).listen_duration_ms) == "45000.500000000"


def test_duplicate_key_last_wins(spark):
    r = one(spark, OKJ[:-1] + ', "action": "SKIP"}')
    assert r.error is None and r.action == "SKIP"


@pytest.mark.parametrize("ts,ttl", [("2024-01-15", 1705363200), ("2024-01-15 10:30", 1705401000),
                                    ("2024-01-15T10:30:00+02:00", 1705393800)])
def test_time_forms(spark, ts, ttl):
    r = one(spark, with_(event_timestamp=ts))
    assert r.error is None and r.ttl == ttl and r.timestamp == ts


def test_summary_counts(spark):
    df = spark.createDataFrame([(n, d) for n, d, _ in CASES], "name string, data string")
    s = ingest.summary(ingest.parse_records(df)).collect()[0]
    expected_ok = sum(1 for _, _, e in CASES if e is None)
    assert (s.records_processed, s.records_failed) == (expected_ok, len(CASES) - expected_ok)


def test_record_without_data_fails(spark):
    df = spark.createDataFrame([(None,)], "data string")
    assert ingest.parse_records(df).collect()[0].error == "bad_record"
