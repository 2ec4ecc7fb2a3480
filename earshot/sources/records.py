"""Events rendered in the producer's wire format, and stream records built from them.

``event_json`` writes an event as the producer does (ISO time with ``Z``, the
fraction left out when it is zero). ``test_records`` derives base64 stream
records from the test overlay, with a fixed set of flaws chosen by
``event_id % 47`` so that every rejection path is exercised on whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..schemas import EVENT_FIELDS, PUBLISH_BATCH_SIZE

# ---- fixed values: flaw classes of the test records (event_id % FLAW_MOD) ---------------
FLAW_MOD = 47
FLAWS = {
    1: "not base64 at all ('!!!')",
    2: "base64 with its last character cut",
    3: "JSON with its closing brace cut",
    4: "session_id absent",
    5: "event_timestamp 'junk'",
    6: "listen_duration_ms 'abc'",
    7: "artist and device_type absent",
    8: "user_id null",
    9: "text after the object",
    10: "byte order mark before the object",
    11: "artist null",
    12: "listen_duration_ms absent",
    13: "a foreign character inside the base64",
    14: "bytes that are not UTF-8",
    15: "event time written with a +02:00 offset",
    16: "action given twice (the last one counts)",
    17: "event time given as a date only",
    18: "a JSON array instead of an object",
}
# -------------------------------------------------------------------------------------------


def unwrapped_base64(b: Column) -> Column:
    """Base64 on one line, as stream producers send it (Spark wraps at 76 chars)."""
    return F.replace(F.base64(b), F.lit("\r\n"), F.lit(""))


def iso_z(ts: Column) -> Column:
    """``YYYY-MM-DDTHH:MM:SS[.ffffff]Z`` of a UTC wall-clock time."""
    frac = F.date_format(ts, "SSSSSS")
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"),
                    F.when(frac != F.lit("000000"), F.concat(F.lit("."), frac)).otherwise(F.lit("")),
                    F.lit("Z"))


def iso_offset(ts: Column, hours: int) -> Column:
    shifted = ts + F.expr(f"INTERVAL {hours} HOURS")
    frac = F.date_format(shifted, "SSSSSS")
    sign = "+" if hours >= 0 else "-"
    return F.concat(F.date_format(shifted, "yyyy-MM-dd'T'HH:mm:ss"),
                    F.when(frac != F.lit("000000"), F.concat(F.lit("."), frac)).otherwise(F.lit("")),
                    F.lit(f"{sign}{abs(hours):02d}:00"))


def event_json(ev: DataFrame, ts_text: Column | None = None) -> Column:
    """The nine fields as one JSON object; NULL fields are written as null."""
    fields = [F.col(f) for f in EVENT_FIELDS[:-1]]
    fields.append((ts_text if ts_text is not None else iso_z(F.col("event_timestamp")))
                  .alias("event_timestamp"))
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def _drop_field(j: Column, name: str) -> Column:
    return F.regexp_replace(j, f'"{name}":(null|"[^"]*"|[^,}}]*),', "")


def _set_field(j: Column, name: str, value_json: str) -> Column:
    return F.regexp_replace(j, f'"{name}":(null|"[^"]*"|[^,}}]*)', f'"{name}":{value_json}')


def test_records(ev: DataFrame) -> DataFrame:
    """(event_id, seq, data): one base64 record per overlay event, some flawed."""
    c = F.col("event_id") % FLAW_MOD
    ts = F.col("event_timestamp")
    ts_text = (F.when(c == 15, iso_offset(ts, 2))
               .when(c == 17, F.date_format(ts, "yyyy-MM-dd"))
               .otherwise(iso_z(ts)))
    j = event_json(ev, ts_text)
    text = (F.when(c == 3, F.expr("substring(_j, 1, length(_j) - 1)"))
            .when(c == 4, _drop_field(F.col("_j"), "session_id"))
            .when(c == 5, _set_field(F.col("_j"), "event_timestamp", '"junk"'))
            .when(c == 6, _set_field(F.col("_j"), "listen_duration_ms", '"abc"'))
            .when(c == 7, _drop_field(_drop_field(F.col("_j"), "artist"), "device_type"))
            .when(c == 8, _set_field(F.col("_j"), "user_id", "null"))
            .when(c == 9, F.concat(F.col("_j"), F.lit(" x")))
            .when(c == 10, F.concat(F.lit("\ufeff"), F.col("_j")))
            .when(c == 11, _set_field(F.col("_j"), "artist", "null"))
            .when(c == 12, F.regexp_replace(F.col("_j"), r'"listen_duration_ms":[^,}]*,', ""))
            .when(c == 16, F.regexp_replace(F.col("_j"), '"action":', '"action":"PLAY","action":'))
            .when(c == 18, F.concat(F.lit("["), F.col("_j"), F.lit("]")))
            .otherwise(F.col("_j")))
    raw = F.when(c == 14, F.concat(F.unhex(F.lit("FF")), F.encode(F.col("_t"), "UTF-8"))) \
        .otherwise(F.encode(F.col("_t"), "UTF-8"))
    b64 = unwrapped_base64(F.col("_raw"))
    data = (F.when(c == 1, F.lit("!!!"))
            .when(c == 2, F.expr("substring(_b64, 1, length(_b64) - 1)"))
            .when(c == 13, F.concat(F.substring(F.col("_b64"), 1, 8), F.lit("!"),
                                    F.expr("substring(_b64, 9)")))
            .otherwise(F.col("_b64")))
    return (ev.withColumn("_j", j).withColumn("_t", text).withColumn("_raw", raw)
            .withColumn("_b64", b64)
            .select("event_id", F.col("event_id").cast("string").alias("seq"), data.alias("data")))


def clean_records(ev: DataFrame, ts_text: Column | None = None) -> DataFrame:
    """(event_id, seq, data) without flaws; ``ts_text`` overrides the time text."""
    return ev.select("event_id", F.col("event_id").cast("string").alias("seq"),
                     unwrapped_base64(F.encode(event_json(ev, ts_text), "UTF-8")).alias("data"))


def envelopes(records: DataFrame, per_envelope: int = PUBLISH_BATCH_SIZE,
              bare_every: int | None = None) -> DataFrame:
    """Group records into ``{"Records": [...]}`` batches of ``per_envelope`` consecutive
    event ids (a fixed bound on every group), as one JSON text per batch. With
    ``bare_every`` = n, envelopes whose id is 3 modulo n end with one extra record
    that has no ``kinesis`` part (a malformed record)."""
    rec = F.struct(F.struct(F.col("data"), F.col("seq").alias("sequenceNumber")).alias("kinesis"))
    grouped = (records.groupBy(F.floor(F.col("event_id") / per_envelope).alias("envelope_id"))
               .agg(F.sort_array(F.collect_list(F.struct(F.col("event_id").alias("o"), rec.alias("r"))))
                    .alias("items")))
    recs = F.transform("items", lambda x: x["r"])
    if bare_every:
        bare = F.array(F.struct(F.lit(None).cast(rec_type()).alias("kinesis")))
        recs = F.when(F.col("envelope_id") % bare_every == 3, F.concat(recs, bare)).otherwise(recs)
    return grouped.select("envelope_id", F.to_json(F.struct(recs.alias("Records"))).alias("value"))


def rec_type() -> str:
    return "struct<data: string, sequenceNumber: string>"
