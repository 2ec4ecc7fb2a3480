"""Stream record batches -> validated, defaulted state items (and rejects).

``parse_records`` adds the decoded fields and an ``error`` column to any
DataFrame with a base64 ``data`` column; the other functions split, summarise
and project it. All of it is one narrow projection per record.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import ingest as X
from ..schemas import STATE_SCHEMA
from ..session import input_bytes

PARSED_COLUMNS = ["decoded", "parsed", "missing_field", "user_id", "timestamp", "session_id",
                  "track_id", "track_title", "artist", "action", "device_type",
                  "listen_duration_ms", "event_time", "ttl", "error"]


TASK_BYTES = 64 << 20
#: Of a table's compressed files, where a row costs some hundred times its reading: rendered or parsed records.
COSTLY_BYTES = 1 << 20


def spread(rows: DataFrame, tasks: int, key: str) -> DataFrame:
    """``rows`` dealt out evenly over ``tasks`` tasks, or over more where they would read over
    ``COSTLY_BYTES`` each, so that no task grows with the table. How many partitions ``rows`` has doesn't
    count: splits of a Parquet file hold whole row groups or nothing, and a join leaves one partition per key at most.
    ``key`` is a column that differs from row to row: rows dealt in turn would be sorted first, by the one task
    that holds them, so that a retry deals them alike."""
    return rows.repartition(max(tasks, -(-input_bytes(rows) // COSTLY_BYTES)), key)


def dealt(records: DataFrame, tasks: int) -> DataFrame:
    """``records`` over ``tasks`` tasks at least; unchanged where they have as many splits."""
    if records._jdf.queryExecution().toRdd().getNumPartitions() >= tasks:
        return records
    return records.repartition(max(tasks, -(-input_bytes(records) // TASK_BYTES)))


def parse_records(records: DataFrame, data: str = "data",
                  partitions: int | None = None, payload: str | None = None) -> DataFrame:
    """Decode and validate every record; the input columns are kept.

    Plan shape: a chain of projections computes each costly step once (cleaned
    base64, bytes, text, wrapped parse, variant, object test, typed fields); a
    value read by several later expressions is its own column, so the optimizer
    keeps it as one evaluation. The result comes out of a one-element ``inline``:
    the generator is an optimizer boundary, so a later filter on ``error`` or a
    field stays above it instead of being pushed down with the whole decode chain
    substituted into it (which would parse every record twice).

    ``partitions``: an input of fewer splits is dealt out over so many tasks first (parsing is CPU
    work per record, and a small batch may arrive as one split), or over more where they would
    read over ``TASK_BYTES`` each. An input of more splits, or without the parameter, stays where
    it is: a large batch isn't shuffled. Tables whose splits may be uneven go through ``spread`` first.

    ``payload`` names a binary column of raw bytes instead (sources such as Kafka
    deliver the JSON bytes themselves); the base64 step is then skipped.
    """
    df = dealt(records, int(partitions)) if partitions else records
    if payload is None:
        df = df.withColumn("_c", X.b64_clean(F.col(data)))
        df = df.withColumn("_payload", X.decode_clean_base64(F.col("_c")))
    else:
        data = payload
        df = df.withColumn("_payload", F.col(payload).cast("binary"))
    df = df.withColumn("_s", F.col("_payload").cast("string"))
    df = df.withColumn("_text", X.valid_text(F.col("_s")))
    df = df.withColumn("_w", X.wrap_parse(F.col("_text")))
    df = df.withColumn("_v", X.unwrap(F.col("_w")))
    df = df.withColumn("_obj", X.is_object(F.col("_v")))
    v, obj = F.col("_v"), F.col("_obj")
    df = df.withColumns({
        "_missing": F.when(obj, X.first_missing(v)),
        "_user_id": X.text_field(v, "user_id"),
        "_ts_text": X.text_field(v, "event_timestamp"),
    })
    df = df.withColumns({"_event_time": X.parse_event_time(F.col("_ts_text")),
                         "_dur": X.duration_decimal(v)})
    error = (F.when(F.col(data).isNull(), F.lit("bad_record"))
             .when(F.col("_payload").isNull(), F.lit("bad_base64"))
             .when(F.col("_text").isNull(), F.lit("bad_utf8"))
             .when(v.isNull(), F.lit("bad_json"))
             .when(~obj, F.lit("not_object"))
             .when(F.col("_missing").isNotNull(), F.concat(F.lit("missing:"), F.col("_missing")))
             .when(F.col("_event_time").isNull(), F.lit("bad_timestamp"))
             .when(F.col("_dur").isNull(), F.lit("bad_duration"))
             .when(F.col("_user_id").isNull(), F.lit("null_key")))
    fields = F.struct(
        F.col("_payload").isNotNull().alias("decoded"),
        obj.alias("parsed"),
        F.col("_missing").alias("missing_field"),
        F.col("_user_id").alias("user_id"),
        F.col("_ts_text").alias("timestamp"),
        X.text_field(v, "session_id").alias("session_id"),
        X.text_field(v, "track_id").alias("track_id"),
        X.with_default(v, "track_title").alias("track_title"),
        X.with_default(v, "artist").alias("artist"),
        X.text_field(v, "action").alias("action"),
        X.with_default(v, "device_type").alias("device_type"),
        F.col("_dur").alias("listen_duration_ms"),
        F.col("_event_time").alias("event_time"),
        X.ttl_epoch(F.col("_event_time")).alias("ttl"),
        error.alias("error"),
    )
    return df.select(*[F.col(c) for c in records.columns], F.inline(F.array(fields)))


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("error").isNull())


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("error").isNotNull())


def summary(parsed: DataFrame) -> DataFrame:
    """records_processed and records_failed of a batch, in one pass."""
    return parsed.agg(F.count_if(F.col("error").isNull()).alias("records_processed"),
                      F.count_if(F.col("error").isNotNull()).alias("records_failed"))


def state_items(parsed: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Accepted records projected to the state item (key: user_id, timestamp)."""
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in STATE_SCHEMA.fields]
    return accepted(parsed).select(*cols, *(extra or []))
