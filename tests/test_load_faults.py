"""Loads that fail half way, bad rows, bounded batches; state logs of odd batches."""

import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from earshot.functions.keys import composite_text
from earshot.plans import load as L
from earshot.plans import suite
from earshot.streaming import ingest_stream as S
from earshot.streaming import state as ST
from test_stream import rec, write_lines


def _load(ev, batch, wh, **options):
    return L.load_batch(ev, batch, wh, arrival="event_id", tie=["event_id"], **options)


def test_failed_fact_write_shows_nothing(spark, tmp_path, monkeypatch):
    even, odd = suite._parts(suite._events(spark, SF_SMALL))
    wh = str(tmp_path / "wh")
    _load(even, 0, wh)
    before = {t: df.count() for t, df in L.read_star(spark, wh).items()}
    write = L.write_fact
    monkeypatch.setattr(L, "write_fact", lambda *a, **k: (write(*a, **k), 1 / 0))
    with pytest.raises(ZeroDivisionError):
        _load(odd, 1, wh)
    assert {t: df.count() for t, df in L.read_star(spark, wh).items()} == before
    monkeypatch.undo()
    _load(odd, 1, wh)                                   # the retry
    assert L.read_star(spark, wh)["fact_listens"].count() == suite._events(spark, SF_SMALL).count()


def test_first_load_that_fails_leaves_an_empty_star(spark, tmp_path, monkeypatch):
    wh = str(tmp_path / "wh")
    monkeypatch.setattr(L, "write_fact", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        _load(suite._events(spark, SF_SMALL), 0, wh)
    assert {df.count() for df in L.read_star(spark, wh).values()} == {0}


def test_a_bad_row_does_not_block_its_batch(spark, tmp_path):
    ev = suite._events(spark, SF_SMALL)
    ev = ev.withColumn("listen_duration_ms", F.when(F.col("event_id") == 5, 2147483648).otherwise(F.col("listen_duration_ms")).cast("bigint"))
    counts = _load(ev, 0, str(tmp_path / "wh"))
    assert counts["load_rejects"] == 1 and counts["fact_listens"] == ev.count() - 1
    assert [r.reason for r in L.read_rejects(spark, str(tmp_path / "wh")).collect()] == ["bad_listen_duration_ms"]


def test_key_text_is_unambiguous(spark):
    rows = [("A|B", "C"), ("A", "B|C"), ("A\\", "|C"), (None, "x"), ("\\N", "x"), ("", "x")]
    df = spark.createDataFrame(rows, "a string, b string")
    texts = [r.t for r in df.select(composite_text([F.col("a"), F.col("b")]).alias("t")).collect()]
    assert len(set(texts)) == len(rows)


def test_many_bounded_batches_equal_one(spark, tmp_path):
    ev = suite._events(spark, SF_SMALL)
    src = str(tmp_path / "src" / "part=0")
    ev.repartition(3).write.parquet(src)

    def run(name, **options):
        wh = str(tmp_path / name)
        L.start_star_load(spark, str(tmp_path / "src" / "*"), ev.schema, wh, str(tmp_path / f"{name}-ck"), arrival="event_id",
                          loaded_at=suite.LOADED_AT, tie=["event_id"], **options).awaitTermination()
        star = L.read_star(spark, wh)
        return L.committed_batch(spark, wh), {t: sorted(map(str, star[t].drop("loaded_at").collect())) for t in star}
    last, one = run("one")
    batches, many = run("many", max_files=1)
    assert last == 0 and batches == 2 and one == many


def test_all_rejected_first_batch(spark, tmp_path):
    root = str(tmp_path)
    write_lines(f"{root}/in", "a.json", [json.dumps({"Records": [{"kinesis": {"data": "abc"}}]})])
    S.start_ingest(spark, f"{root}/in", root, f"{root}/ckpt").awaitTermination()
    assert S.read_log(spark, root).count() == 0
    assert S.compact(spark, root, 0) == 0


def test_unnumbered_files_go_by_their_time(spark, tmp_path):
    root = str(tmp_path)
    for name, action, when in (("z.json", "PLAY", 1_000_000), ("a.json", "SKIP", 2_000_000)):
        r = rec(1, action=action)
        del r["kinesis"]["sequenceNumber"]
        write_lines(f"{root}/in", name, [json.dumps({"Records": [r]})])
        os.utime(f"{root}/in/{name}", (when, when))
    S.start_ingest(spark, f"{root}/in", root, f"{root}/ckpt").awaitTermination()
    assert [r.action for r in ST.latest_state(S.read_log(spark, root)).collect()] == ["SKIP"]


def test_compaction_trims_the_log(spark, tmp_path):
    root = str(tmp_path)
    for i in range(3):
        write_lines(f"{root}/in", f"{i}.json", [json.dumps({"Records": [rec(i, user_id=f"u{i}")]})])
        S.start_ingest(spark, f"{root}/in", root, f"{root}/ckpt").awaitTermination()
        S.compact(spark, root, 0)
    assert sorted(p.name for p in (tmp_path / "state_log").glob("batch_id=*")) == ["batch_id=2"]
    assert {r.user_id for r in ST.latest_state(S.read_log(spark, root)).collect()} == {"u0", "u1", "u2"}


def test_json_lines_and_arrays_keep_what_they_cannot_read(spark, tmp_path):
    from earshot.sources import files as R
    good = '{"user_id":"u","listen_duration_ms":45000.5,"event_timestamp":"2024-01-15T10:30:00Z"}'
    (tmp_path / "lines.json").write_text(f'{good}\n{{"user_id": \n\nnull\n{{"listen_duration_ms":"x"}}\n')
    path = str(tmp_path / "lines.json")
    rows = R.read_json_lines(spark, path).collect()
    assert [float(r.listen_duration_ms) for r in rows] == [45000.5] and R.read_json_lines(spark, path).count() == 1
    assert R.json_rejects(spark, path).count() == 3
    (tmp_path / "arrays").mkdir()
    (tmp_path / "arrays" / "a.json").write_text(f"[{good},\n{good}]")
    (tmp_path / "arrays" / "b.json").write_text("[{")
    assert R.read_json_array(spark, str(tmp_path / "arrays")).count() == 2
    assert [r.raw for r in R.json_rejects(spark, str(tmp_path / "arrays"), True).collect()] == ["[{"]
